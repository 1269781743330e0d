"""Line dedup."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from lokum.llm import line_dedup

PROSE = "here is a line of words about the number {} that nobody else wrote down today"
FILL = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
ROWS = ([(i, f"own text {FILL[i]} here\nCopyright 20{i:02} by us\n\n  Last seen by {FILL[i]} on our big public site today  ")
         for i in range(6)]
        + [(10, None), (11, ""), (12, "\n\n"), (13, "Copyright 1999 by us"), (13, "Copyright 1999 by us"),
           (None, "Last seen by nobody on our big public site today"), (14, "w " * 50_000 + "end"),
           (15, "Last seen by someone very different indeed at home now")])


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("uid", "line", "pos", "flags", "whole", "leaf", "salt", "body"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def masked(line):
    return re.sub("[\x20\x09-\x0d]+", " ", re.sub("[^\x20\x09-\x0d]*[0-9][^\x20\x09-\x0d]*", "<*>", line)).strip(" ")


def generalised(texts):
    """Line to its template: leaf and the constants, None where under 60 percent stay."""
    leaves = defaultdict(list)
    for line in texts:
        t = line.split(" ")
        if len(t) >= 8:
            leaves[len(t), *t[:3]].append(line)
    out = {}
    for leaf, lines in leaves.items():
        total = sum(len(texts[x]) for x in lines)
        often = defaultdict(int)
        for line in lines:
            for at, w in enumerate(line.split(" ")):
                often[at, w] += len(texts[line])
        for line in lines:
            same = [(at, w) for at, w in enumerate(line.split(" "))
                    if at < 3 or often[at, w] >= 5 and often[at, w] * 10 >= total]
            if len(lines) > 1 and len(same) * 10 >= leaf[0] * 6:
                out[line] = (leaf, *same)
    return out


def expect(rows):
    texts = defaultdict(set)
    for _, t in rows:
        for line in (t or "").split("\n"):
            if masked(line):
                texts[masked(line)].add(t)
    template = generalised(texts)
    held = defaultdict(set)
    for line, k in template.items():
        held[k] |= texts[line]
    own = defaultdict(set)
    for line, ts in texts.items():
        for t in ts if len(ts) < 5 else ():
            own[t].add(line)

    def passage(line):
        return len(line.split(" ")) >= 50 and any(
            2 * len(own[a] & own[b]) <= max(len(own[a]), len(own[b])) for a in texts[line] for b in texts[line] if a != b)

    gone = {x for x in texts if len(texts[x]) >= 5 or x in template and len(held[template[x]]) >= 5 or passage(x)}
    out = []
    for k, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if masked(x) not in gone]
        out.append((k, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def run(df, **options):
    return sorted((tuple(r) for r in line_dedup.drop_recurring_lines(df, **options).drop("uid").collect()), key=str)


def test_edges(spark):
    got = run(frame(spark))
    assert got == sorted(expect(ROWS), key=str)
    by = {r[0]: r[1] for r in got}
    assert by[0] == "own text alpha here\n" and by[13] == "" and by[None] == ""
    assert by[15] == ROWS[-1][1]


def test_copies_of_a_text_count_once(spark):
    rows = [(i, "one line that all copies share between them and more") for i in range(50)]
    assert run(frame(spark, rows)) == sorted(expect(rows), key=str)
    assert all(r[3] == 0 for r in run(frame(spark, rows)))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(docs) == sorted(expect(rows), key=str)


def test_empty(spark):
    assert run(frame(spark, [])) == []


def test_variable_word_in_each_half(spark):
    rows = [(i, f"note {i} {w}\nposted on behalf of {w} in the city of {FILL[-1 - i]} by the same desk")
            for i, w in enumerate(FILL)]
    got = run(frame(spark, rows))
    assert got == sorted(expect(rows), key=str)
    assert all(r[3] == 1 and "posted" not in r[1] for r in got)


def test_prose_with_a_common_opening_stays(spark):
    ends = ["long road they found a small house", "year nobody could say what had happened",
            "war many people left for other lands", "film she was crying without a sound",
            "table sat a man with grey hair", "garden grew roses of every possible colour",
            "day we counted all money twice over", "lesson our teacher gave us more homework"]
    rows = [(i, f"At the end of the {e}") for i, e in enumerate(ends)]
    got = run(frame(spark, rows))
    assert got == sorted(expect(rows), key=str) and all(r[3] == 0 for r in got)


def test_long_passages_recur_from_two_texts_on(spark):
    passage = " ".join(f"{a}{b}" for a in FILL for b in FILL[:7])
    own = [" ".join(f"{w}{a}" for a in FILL for w in ("own", f"x{chr(97 + i)}")) for i in range(8)]
    near = [" ".join(f"near{a}{b}" for a in FILL for b in FILL[:7]) + f" {w}" for w in FILL[:3]]
    rows = ([(i, f"{own[i]}\n{passage}") for i in range(2)] + [(2, f"{own[2]}\n{passage[:60]}")]
            + [(10 + i, "\n".join([*near, f"changed line {w}"])) for i, w in enumerate(FILL[:2])])
    got = run(frame(spark, rows))
    assert got == sorted(expect(rows), key=str)
    assert {r[0]: r[3] for r in got} == {0: 1, 1: 1, 2: 0, 10: 0, 11: 0}


def test_a_line_in_every_text(spark):
    rows = [(i, f"body {FILL[i % 8]} {'abcdefghij'[i // 100]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}\n\n"
                "the very same footer stands below each of all these texts") for i in range(400)]
    got = run(frame(spark, rows))
    assert got == sorted(expect(rows), key=str) and all(r[3] == 1 for r in got)
