"""Line dedup with a fixed-depth log-template tree (native: DataFrame functions
only).

A line is trimmed and split at white space; tokens that hold a digit are
variable and become ``<*>``. The tree has fixed levels: number of tokens, then
the ``DEPTH`` leading tokens; a leaf holds the lines that agree in both. In a
leaf a token is constant at its position if it stands there in at least
``min_docs`` of the leaf's line-in-text occurrences and in ``CONSTANT_PERCENT``
of them; all others are variable fields. Lines of a leaf that are left with the
same constants in the same places, ``SAME_PERCENT`` of the line with the leading
tokens, merge into one template. Lines of under ``VARIABLE_FROM`` tokens have no
variable fields but those with digits.

Dropped everywhere, in all texts that hold them, are the lines

* whose whole masked line, or whose template, stands in ``min_docs`` or more
  different texts;
* of ``LONG`` or more tokens whose whole masked line stands in two or more
  different texts that are not near copies of each other. Two texts are, if of
  the lines that recur in fewer than ``min_docs`` texts (or not at all) more than
  half of either text's are shared. At most ``min_docs - 1`` texts hold such a
  line, so its pairs of texts are bounded by that parameter.

Exact copies of a text count once. ``min_docs`` or more near copies count as
different texts: run near-dedup before. Blank lines stay.

Counts are aggregated before the shuffle; joins on a line, leaf, token or
template spread each key over ``SALTS`` parts of its rows, so neither a line in a
third of all texts nor a leaf with a third of all lines meets in one task. A
document gathers no more than its own lines' flags.

Defined cases: null text stays null and has no lines; empty text has one blank
line; repeated rows are cleaned each; null ids are kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import col, stable, with_uid, work_table

DEPTH = 3
MIN_DOCS = 5
VARIABLE_FROM = 8  # tokens; shorter lines are compared whole
LONG = 50  # tokens; such a line recurs from two texts on
CONSTANT_PERCENT = 10
SAME_PERCENT = 60
SALTS = 16
LEAF_BUCKETS = 1 << 20  # bounds the broadcast that spares lines of single leaves the shuffle
# looked for at the starts of tokens only, without stepping back
TOKEN_WITH_DIGIT = "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def masked_line(line: Column) -> Column:
    """The line with variable tokens masked and single spaces."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, TOKEN_WITH_DIGIT, "<*>")).otherwise(line)
    spaced = masked.rlike("[\\x09-\\x0D]|\\x20\\x20")
    return F.trim(F.when(spaced, F.regexp_replace(masked, WHITE_RUN, " ")).otherwise(masked))


def salted_join(many: DataFrame, few: DataFrame, on: list[str], spread: str, how: str = "inner") -> DataFrame:
    """A join whose keys are split by ``spread``, a column of ``many``, over
    ``SALTS`` parts; ``few`` is repeated for each."""
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    left = many.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return left.join(few.withColumn("salt", F.explode(salts)), [*on, "salt"], how).drop("salt")


def lines_of(rows: DataFrame) -> DataFrame:
    """rows(uid, text) to uid, body, pos, n, whole, leaf, masked: whole is null for
    blank lines, leaf and masked for lines without variable fields too."""
    masked, n = F.col("masked"), F.col("n")
    spaces = F.length("masked") - F.length(F.replace(masked, F.lit(" "), F.lit("")))
    path = F.concat_ws("\n", n, F.substring_index(masked, " ", DEPTH))
    deep = (masked != "") & (n >= VARIABLE_FROM)
    return (rows.select("uid", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .select("uid", "body", "pos", masked_line(F.col("line")).alias("masked"))
            .select("uid", "body", "pos", "masked", (spaces + 1).alias("n"))
            .select("uid", "body", "pos", "n", F.when(masked != "", F.unhex(F.md5(masked))).alias("whole"),
                    F.when(deep, F.unhex(F.md5(path))).alias("leaf"), F.when(deep, masked).alias("masked")))


def templates(lines: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """whole, template: the merged lines of every leaf that holds different ones."""
    leaves = work_table(
        counts.where("leaf is not null").groupBy("leaf")
        .agg(F.sum("docs").alias("total"), F.count(F.lit(1)).alias("variants"))
        .where((F.col("total") >= min_docs) & (F.col("variants") > 1)).select("leaf", "total"), "leaves")
    # most leaves hold one line: those outside the buckets of the others stay where they are
    bucket = F.pmod(F.xxhash64("leaf"), F.lit(LEAF_BUCKETS)).alias("bucket")
    buckets = leaves.select(bucket).distinct()
    near = (lines.where("leaf is not null").select("leaf", "whole", "n", "masked", bucket)
            .join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket"))
    held = salted_join(near, leaves, ["leaf"], "whole").distinct()
    rest = F.slice(F.split("masked", " "), F.lit(DEPTH + 1), F.col("n") - DEPTH)
    tokens = work_table(
        held.join(counts.select("whole", "docs"), "whole")
        .select("leaf", "total", "whole", "n", "docs", F.posexplode(rest).alias("at", "token"))
        .withColumn("token", F.unhex(F.md5("token"))), "tokens")
    often = F.sum("docs")
    constants = (tokens.groupBy("leaf", "total", "at", "token").agg(often.alias("often"))
                 .where((F.col("often") >= min_docs) & (F.col("often") * 100 >= F.col("total") * CONSTANT_PERCENT))
                 .select("leaf", "at", "token"))
    fixed = F.sort_array(F.collect_list(F.struct("at", "token")))
    path = F.array_join(F.transform(fixed, lambda x: F.concat(x["at"], F.lit(":"), F.hex(x["token"]))), ",")
    return (salted_join(tokens.select("leaf", "whole", "n", "at", "token"), constants, ["leaf", "at", "token"], "whole")
            .groupBy("whole", "leaf", "n").agg(F.count(F.lit(1)).alias("same"), path.alias("path"))
            .where((F.col("same") + DEPTH) * 100 >= F.col("n") * SAME_PERCENT)
            .select("whole", F.unhex(F.md5(F.concat_ws("\n", F.hex("leaf"), "path"))).alias("template")))


def recurring_templates(members: DataFrame, seen: DataFrame, min_docs: int) -> DataFrame:
    """whole: the lines whose template stands in ``min_docs`` or more texts."""
    texts = salted_join(seen.select("whole", "body"), members, ["whole"], "body").select("template", "body").distinct()
    often = texts.groupBy("template").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)
    return salted_join(members, often.select("template"), ["template"], "whole").select("whole")


def long_passages(seen: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """whole: the long lines in two or more texts that are not near copies."""
    rare = counts.where((F.col("docs") >= 2) & (F.col("docs") < min_docs)).select("whole")
    bodies = (salted_join(seen.select("whole", "n", "body"), rare, ["whole"], "body")
              .groupBy("whole", "n").agg(F.sort_array(F.collect_list("body")).alias("bodies")))
    later = F.transform("bodies", lambda a, i: F.transform(
        F.slice("bodies", i + 2, F.lit(min_docs)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    links = work_table(bodies.select("whole", "n", F.explode(F.flatten(later)).alias("pair"))
                       .select("whole", "n", "pair.a", "pair.b"), "links")
    shared = (links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("longest"))
              .where(F.col("longest") >= LONG))
    common = counts.where(F.col("docs") >= min_docs).select("whole")
    own = salted_join(seen.select("whole", "body"), common, ["whole"], "body", "left_anti").groupBy("body").agg(
        F.count(F.lit(1)).alias("own"))
    near = (shared.join(own.select(F.col("body").alias("a"), F.col("own").alias("own_a")), "a")
            .join(own.select(F.col("body").alias("b"), F.col("own").alias("own_b")), "b")
            .where(F.col("shared") * 2 > F.greatest("own_a", "own_b")).select("a", "b"))
    return links.where(F.col("n") >= LONG).join(near, ["a", "b"], "left_anti").select("whole")


def flagged_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """rows(uid, text) to uid, n_dropped, flags (a drop flag per line): the rows
    that lose a line."""
    lines = work_table(lines_of(rows), "lines")
    seen = work_table(lines.where("whole is not null").select("whole", "body", "n", "leaf").distinct(), "seen")
    counts = work_table(seen.groupBy("whole", "n", "leaf").agg(F.count(F.lit(1)).alias("docs")).where(
        (F.col("docs") > 1) | F.col("leaf").isNotNull()), "counts")
    members = work_table(templates(lines, counts, min_docs), "members")
    dropped = work_table(counts.where(F.col("docs") >= min_docs).select("whole")
                         .union(recurring_templates(members, seen, min_docs))
                         .union(long_passages(seen, counts, min_docs)).distinct(), "dropped")
    filled = lines.where("whole is not null").select("uid", "pos", "whole")
    marked = (salted_join(filled, dropped.withColumn("drop", F.lit(True)), ["whole"], "uid", "left")
              .select("uid", "pos", F.coalesce("drop", F.lit(False)).alias("drop"))
              .union(lines.where("whole is null").select("uid", "pos", F.lit(False))))
    flags = F.transform(F.sort_array(F.collect_list(F.struct("pos", "drop"))), lambda x: x["drop"])
    return (marked.groupBy("uid").agg(F.count_if("drop").alias("n_dropped"), flags.alias("flags"))
            .where("n_dropped > 0"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text (cleaned), n_lines, n_dropped, uid: one row per input row."""
    docs = stable(docs)
    rows = with_uid(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), "uid")
    flags = work_table(flagged_lines(rows, min_docs), "flags")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.get(F.col("flags"), i)), "\n")
    # a merge join at every size: flags grow with the documents
    return rows.join(flags.hint("merge"), "uid", "left").select(
        "doc_id", F.when(F.col("flags").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "uid")
