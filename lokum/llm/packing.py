"""Best-fit packing planned on a length histogram.

1. Tokenise: every document becomes its ids plus a final separator id; only
   documents over ``capacity`` are cut, the first piece takes the remainder.
2. The histogram of piece lengths has at most ``capacity`` rows. Best-fit
   decreasing runs over its counts, never over documents: sequences with the
   same room left are handled as one run of consecutive sequence numbers, so
   the plan's size follows the lengths, not the corpus.
3. Pieces get a rank within their length (salted: a length is split into groups
   of about ``RANK_ROWS`` rows whose counts are summed first) and take the slot
   that the plan gives that rank.

Defined cases: null text counts as empty (one separator id); a text that holds a
token added to the vocabulary (``<|endoftext|>``) is encoded whole, the token to its
one id; repeated rows are packed each; null ids are kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lokum.llm.common import by_bytes, col, give_back, with_uid, work_table

CAPACITY = 2048
SEPARATOR = 0
TOKENIZER = "byte_bpe_50k.json"
RANK_ROWS = 1024
CACHE_BYTES = 72 << 20  # of a task's looked-up parts, about; two generations
MARKS = ".,;:!?"
MARKED = re.compile("[A-Za-z\u00c0-\u024f]+[.,;:!?]")


@lru_cache(maxsize=1)
def vocabulary(path: str) -> tuple:
    """The tokenizer, loaded once a worker (of fixed size, unlike what a task looks
    up), and which ids start with a space."""
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
    t = Tokenizer.from_file(path)
    return t, np.array([(t.id_to_token(i) or "").startswith("\u0120") for i in range(t.get_vocab_size())])


class ChunkEncoder:
    """Token ids of whole texts. The vocabulary splits texts before its merges,
    and a single space between two other characters always starts a new part, so
    the parts cut there encode on their own and repeated ones are looked up: the
    parts of the task's last texts, up to two generations of ``CACHE_BYTES``."""

    def __init__(self, path: str):
        self.tokenizer, self.opens = vocabulary(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # ids of a space and the part
        self.older: dict[str, bytes] = {}
        self.held = 0

    @staticmethod
    def parts(text: str) -> list[str]:
        """What follows each space at which the text may be cut; the first part
        is what stands before the first of them."""
        words = text.split(" ")
        if "" not in words and " ".join(map(str.strip, words)) == text:
            return words  # no white space beside a space or at an end
        out = [words[0]]
        for w in words[1:]:
            # cut only between two characters that are not white space
            if w and not w[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(w)
            else:
                out[-1] += " " + w
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 4096):
            got = self.tokenizer.encode_batch_fast(texts[i:i + 4096], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in got]
        return out

    def spaced_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of each part with a space before it. Parts without a space are
        encoded in one string: there an id that starts with a space starts a part."""
        out: list[bytes] = []
        for i in range(0, len(parts), 4096):
            block = parts[i:i + 4096]
            joined = " " + " ".join(block)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(starts) != len(block):
                raise AssertionError("a part was split at a space")
            body = ids.tobytes()
            out += [body[a:b] for a, b in zip(starts, [*starts[1:], len(body)])]
        return out

    def learn(self, parts: set[str]) -> None:
        if self.held > CACHE_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        self.held += sum(map(len, parts)) + 200 * len(parts)
        known, older = self.known, self.older
        found = {p: older[p] for p in parts if p in older}
        known.update(found)
        parts = parts.difference(found)
        # a word and one mark behind it are two parts to the vocabulary
        marked = [p for p in parts if MARKED.fullmatch(p) and p[:-1].isalpha()]
        new = parts.difference(marked).union(p[:-1] for p in marked).difference(known)
        plain = [p for p in new if " " not in p and p.strip() == p]
        known.update(zip(plain, self.spaced_ids(plain)))
        odd = list(new.difference(plain))
        known.update(zip(odd, self.ids([" " + p for p in odd])))
        for p in marked:
            known[p] = known[p[:-1]] + self.marks[p[-1]]

    @cached_property
    def marks(self) -> dict[str, bytes]:
        return dict(zip(MARKS, self.ids(list(MARKS))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        whole = [k for k, t in enumerate(texts) if any(a in t for a in self.added)]
        if whole:
            out = self.encode_parts([t for k, t in enumerate(texts) if k not in whole])
            for k, ids in zip(whole, self.ids([texts[k] for k in whole])):
                out.insert(k, ids)
            return out
        return self.encode_parts(texts)

    def encode_parts(self, texts: list[str]) -> list[bytes]:
        split = [self.parts(t) for t in texts]
        new = set().union(*(p[1:] for p in split)).difference(self.known)
        if new:
            self.learn(new)
        known, older = self.known, self.older
        try:
            tails = [b"".join(map(known.__getitem__, p[1:])) for p in split]
        except KeyError:  # the generation has just changed
            tails = [b"".join([known.get(x) or older[x] for x in p[1:]]) for p in split]
        return [h + t for h, t in zip(self.ids([p[0] for p in split]), tails)]


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = length % capacity or min(length, capacity)
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def lists(body: list[bytes]) -> pa.ListArray:
    """32-bit ids as an array column."""
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in body]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(body), "<i4")))


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, separator: int,
           tokenizer: str | None, ids: str | None, digest: bool) -> DataFrame:
    """doc_id, uid, piece, start, length and as asked the piece's ids, their CRC-32."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = with_uid(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), "uid")
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([separator], "<u4").tobytes()
    names = ["doc_id", "uid", "piece", "start", "length", *["ids"] * bool(ids), *["ids_crc32"] * digest]

    def run(batches):
        encoder = None
        try:
            for b in batches:
                encoder = encoder or ChunkEncoder(path)
                for part in by_bytes(b, 1, rows=256):
                    row, piece, start, length, body = [], [], [], [], []
                    for r, own in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                        own += end
                        for k, (s, n) in enumerate(cut(len(own) // 4, capacity)):
                            row.append(r), piece.append(k), start.append(s), length.append(n)
                            body.append(own[4 * s:4 * (s + n)])
                    at = pa.array(row, pa.int64())
                    out = [part.column(0).take(at), part.column(2).take(at), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64())]
                    if ids:
                        out.append(pa.array(body, pa.binary()) if ids == "binary" else lists(body))
                    if digest:
                        out.append(pa.array(map(zlib.crc32, body), pa.int64()))
                    yield pa.RecordBatch.from_arrays(out, names)
        finally:
            encoder = None
            give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, uid long, piece int, start long, length long"
                                + (f", ids {'binary' if ids == 'binary' else 'array<int>'}" if ids else "")
                                + ", ids_crc32 long" * digest)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows (length, lo, hi, sequence, each,
    offset): ranks lo to hi - 1 of the length go, ``each`` to a sequence, to the
    sequences from ``sequence`` on, the first at ``offset``."""
    out: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[int] = []  # sorted rooms left; of each the runs (first sequence, count)
    runs: dict[int, list[tuple[int, int]]] = {}
    made = 0

    def add(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, count))

    def fill(length: int, lo: int, n: int, room: int, first: int, count: int) -> int:
        """Put up to n pieces into ``count`` sequences with this room."""
        each = room // length
        full = min(count, n // each)
        if full:
            out.append((length, lo, lo + full * each, first, each, capacity - room))
            add(room - each * length, first, full)
        done, rest = full * each, min(n - full * each, each - 1) if full < count else 0
        if rest:
            out.append((length, lo + done, lo + done + rest, first + full, rest, capacity - room))
            add(room - rest * length, first + full, 1)
        used = full + bool(rest)
        add(room, first + used, count - used)
        return done + rest

    for length in sorted(histogram, reverse=True):
        n, lo = histogram[length], 0
        at = bisect.bisect_left(rooms, length)
        while lo < n and at < len(rooms):
            room = rooms.pop(at)  # the tightest room that fits
            for first, count in runs.pop(room):
                got = fill(length, lo, n - lo, room, first, count) if lo < n else 0
                if not got:
                    add(room, first, count)
                lo += got
            at = bisect.bisect_left(rooms, length)
        if lo < n:
            count = -(-(n - lo) // (capacity // length))
            lo += fill(length, lo, n - lo, capacity, made, count)
            made += count
    return out


def ranked(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows with a rank (from 0) within their length. sizes(length, n) has at
    most ``capacity`` rows."""
    groups = F.broadcast(sizes.select("length", F.ceil(F.col("n") / F.lit(RANK_ROWS)).alias("groups")))
    dealt = (rows.join(groups, "length")
             .withColumn("salt", F.pmod(F.xxhash64("uid", "piece"), F.col("groups"))).drop("groups"))
    before = (dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
              .select("length", "salt", "base"))
    within = Window.partitionBy("length", "salt").orderBy("uid", "piece")
    return (dealt.withColumn("nth", F.row_number().over(within) - 1).join(before, ["length", "salt"])
            .withColumn("rank", F.col("base") + F.col("nth")).drop("salt", "base", "nth"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         separator: int = SEPARATOR, tokenizer: str | None = None, ids: str | None = "array", digest: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (an array of 32-bit ids, or
    "binary": the same little-endian, end to end; None: no ids), ids_crc32 (if
    ``digest``), sequence_id, offset. ``tokenizer`` is the path of a vocabulary file
    on every worker; by default the installed public byte-level one."""
    spark = docs.sparkSession
    rows = work_table(pieces(docs, id_col, text_col, capacity, separator, tokenizer, ids, digest), "pieces")
    # a row per length, at most ``capacity`` of them
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = spark.createDataFrame(sorted(histogram.items()), "length long, n long")
    slots = spark.createDataFrame(plan(histogram, capacity),
                                  "length long, lo long, hi long, first long, each long, at long")
    in_order = F.col("rank") - F.col("lo")
    small = ranked(rows.select("length", "uid", "piece"), sizes)
    placed = (small.join(F.broadcast(slots), "length").where("rank >= lo and rank < hi")
              .select("uid", "piece", (F.col("first") + F.floor(in_order / F.col("each"))).alias("sequence_id"),
                      (F.col("at") + F.pmod(in_order, F.col("each")) * F.col("length")).alias("offset")))
    return (rows.join(placed, ["uid", "piece"])
            .select("doc_id", "piece", "start", "length", *["ids"] * bool(ids), *["ids_crc32"] * digest, "sequence_id", "offset"))
