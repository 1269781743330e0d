"""Language ID with segmentation-marginalised unigrams.

A language is a unigram model over the pieces of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, by a
forward pass over its characters; a text's is the product over its words (words
are runs of letters, lower-cased, with the vocabulary's word mark in front; a
letter outside the vocabulary has a small fixed probability). Models are trained
by expectation-maximisation: expected piece counts come from forward-backward
passes over all words, whatever their length, of a bounded sample of labelled rows, are summed by Spark
and only the table of pieces times languages reaches the driver.

``score`` is the posterior of the predicted language under equal priors.

Defined cases: null text or text without a letter is ``und`` with score 0; ties
go to the first language in code-point order; rows without label or text are
never learned from; without any labelled row all predictions are ``und``; of
repeated rows each is predicted; texts are read whole, whatever their length;
null ids are predicted and never learned from; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import by_bytes, col, free_name, give_back, with_uid, work_table

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_ROWS = 1500     # labelled rows a language that are learned from (expected number)
ITERATIONS = 3
SMOOTHING = 0.05       # added to every piece's expected count
UNKNOWN = 1e-9         # probability of a letter outside the vocabulary
KNOWN_BYTES = 32 << 20  # of a task's looked-up chunks, about
UNDETERMINED = "und"
MARK = "▁"
RUNS = re.compile(r"[^\W\d_]+")


class Trie:
    """The vocabulary's pieces by characters, walked for many words at once."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        self.pieces = max(pieces.values()) + 1
        self.longest = max(map(len, pieces))
        node = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
        letters = {c: k + 1 for k, c in enumerate(sorted({p[-1] for p in node if p}))}
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        self.width = len(letters) + 1
        edges = sorted((node[p[:-1]] * self.width + letters[p[-1]], k) for p, k in node.items() if p)
        self.edge = np.array([e for e, _ in edges])
        self.child = np.array([k for _, k in edges])
        self.piece = np.full(len(node), -1)
        self.piece[[node[p] for p in pieces]] = list(pieces.values())

    def lattice(self, words: list[str]) -> np.ndarray:
        """ids[word, end, length] of all pieces in words of one length. Where
        there is none the id is ``pieces``; a letter without a piece of its own
        has the id ``pieces`` + 1."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)
        letter = self.letter[codes]
        ids = np.full((len(words), n + 1, min(n, self.longest) + 1), self.pieces, np.int32)
        for i in range(n):
            rows, at = np.arange(len(words)), np.zeros(len(words), np.int64)
            for size in range(1, min(self.longest, n - i) + 1):
                want = at * self.width + letter[rows, i + size - 1]
                found = np.minimum(np.searchsorted(self.edge, want), len(self.edge) - 1)
                there = self.edge[found] == want
                rows, at = rows[there], self.child[found[there]]
                if not len(rows):
                    break
                piece = self.piece[at]
                full = piece >= 0
                ids[rows[full], i + size, size] = piece[full]
            single = ids[:, i + 1, 1]
            single[single == self.pieces] = self.pieces + 1
        return ids


def trie(path: str) -> Trie:
    return Trie(path)


def letters(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    text = text.lower()
    if text.isalpha():
        return [text]
    out = []
    for run in RUNS.findall(text):
        out += [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()
    return out


def forward(ids: np.ndarray, p: np.ndarray, scale: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all segmentations of the prefixes, scaled; log of the scale and
    total. p[piece, language] ends with a row for no piece and one for a letter
    without a piece."""
    words, n, longest = ids.shape[0], ids.shape[1] - 1, ids.shape[2] - 1
    a = np.zeros((words, n + 1, p.shape[1]))
    a[:, 0] = 1.0
    log = np.zeros(words)
    for j in range(1, n + 1):
        for size in range(1, min(j, longest) + 1):
            a[:, j] += a[:, j - size] * p[ids[:, j, size]]
        if scale and j % 16 == 0:
            top = a[:, j].max(axis=1)
            small = top < 1e-100
            if small.any():
                top = np.where(small, top, 1.0)
                a[:, max(0, j - longest):j + 1] /= top[:, None, None]
                log += np.log(top)
    with np.errstate(divide="ignore"):
        return a, log[:, None] + np.log(a[:, n])


def expected(ids: np.ndarray, p: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
    """Adds the expected piece counts of the words to ``out`` (one language).
    Prefix sums are kept relative to the last one, so words may have any length."""
    n, longest = ids.shape[1] - 1, ids.shape[2] - 1
    share = p[ids]  # of the segmentations with a cut at the end, those whose last piece has the length
    before = np.zeros((len(ids), longest + 1))  # sums of the prefixes that are so many letters shorter
    for j in range(1, n + 1):
        before[:, 1] = 1.0
        share[:, j] *= before
        total = share[:, j].sum(axis=1, keepdims=True)
        share[:, j] /= total
        before[:, 2:] = before[:, 1:-1] / total
    share[:, 0] = 0.0
    cut = np.zeros((len(ids), n + 1))  # expected number of cuts at an end
    cut[:, n] = weight
    for j in range(n, 0, -1):
        share[:, j] *= cut[:, j, None]
        most = min(j, longest)
        cut[:, j - most:j] += share[:, j, most:0:-1]
    out += np.bincount(ids.ravel(), share.ravel(), len(out))


def by_length(words, cells: int = 60_000):
    """Index lists of words of one length, bounded in letters."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        n = len(words[order[at]])
        most = max(1, cells // n)
        end = at
        while end < len(order) and end - at < most and len(words[order[end]]) == n:
            end += 1
        yield order[at:end]
        at = end


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    p: np.ndarray      # pieces + 2 rows, one column a language
    vocabulary: str


class Scorer:
    """Scores whole texts; chunks met before by this task are looked up."""

    def __init__(self, model: LanguageModel):
        self.model, self.known, self.held = model, {}, 0
        self.trie = trie(model.vocabulary)
        self.logs = np.zeros((1024, len(model.languages)))
        self.letters = np.zeros(1024, bool)

    def learn(self, chunks: list[str]) -> None:
        """Log-probabilities of chunks between white space."""
        own = [letters(c) for c in chunks]
        words = list({w for ws in own for w in ws})
        logs = np.zeros((len(words), self.logs.shape[1]))
        for part in by_length(words):
            logs[part] = forward(self.trie.lattice([MARK + words[k] for k in part]), self.model.p)[1]
        at = {w: k for k, w in enumerate(words)}
        need = len(self.known) + len(chunks)
        if need > len(self.letters):
            size = max(need, 2 * len(self.letters))
            self.logs = np.concatenate((self.logs, np.zeros((size - len(self.logs), self.logs.shape[1]))))
            self.letters = np.concatenate((self.letters, np.zeros(size - len(self.letters), bool)))
        first = len(self.known)
        self.known.update(zip(chunks, range(first, need)))
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        words_at = np.fromiter((at[w] for ws in own for w in ws), np.int64, int(sizes.sum()))
        self.logs[first:need] = 0.0
        np.add.at(self.logs, np.repeat(np.arange(first, need), sizes), logs[words_at])
        self.letters[first:need] = sizes > 0

    def predict(self, texts: list[str | None]) -> list[tuple[str | None, float]]:
        """Languages and scores; no language for texts without a letter."""
        split = [t.lower().split() if t else [] for t in texts]
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        new = list(dict.fromkeys(c for chunks in split for c in chunks if c not in self.known))
        if new:
            self.held += sum(map(len, new)) + len(new) * (200 + 8 * self.logs.shape[1])
            self.learn(new)
        out = []
        for chunks in split:
            at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
            if not len(self.model.languages) or not self.letters[at].any():
                out.append((None, 0.0))
                continue
            log = self.logs[at].sum(0)
            best = int(log.argmax())
            out.append((self.model.languages[best], float(1.0 / np.exp(log - log[best]).sum())))
        return out


def held_out(id_column: Column, modulus: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; null ids give null."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus == rest


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          learn_from: Column | None = None, sample_rows: int = SAMPLE_ROWS, iterations: int = ITERATIONS,
          vocabulary: str | None = None) -> LanguageModel:
    """Fit on about ``sample_rows`` labelled rows a language, chosen by a hash of
    the id. ``vocabulary`` is a path on every worker."""
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    usable = docs.where(col(lang_col).isNotNull() & col(text_col).isNotNull() & col(id_col).isNotNull())
    if learn_from is not None:
        usable = usable.where(learn_from)
    # one row a language
    sizes = {r[0]: r[1] for r in usable.groupBy(col(lang_col).alias("l")).agg(F.count(F.lit(1))).collect()}
    languages = tuple(sorted(sizes))
    v = trie(path).pieces
    if not languages:
        return LanguageModel((), np.zeros((v + 2, 0)), path)
    rates = spark.createDataFrame([(x, k, min(1.0, sample_rows / sizes[x])) for k, x in enumerate(languages)],
                                  "lang string, k int, rate double")
    unit = F.pmod(F.xxhash64(col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (usable.select(col(lang_col).alias("lang"), col(text_col).alias("text"), unit.alias("unit"))
              .join(F.broadcast(rates), "lang").where("unit < rate").select("k", "text"))

    def count(batches):
        for b in (part for whole in batches for part in by_bytes(whole, 1, 4 << 20, 4096)):
            n: Counter = Counter()
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n.update((k, w) for w in letters(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in n], pa.int32()), pa.array([w for _, w in n], pa.string()),
                 pa.array(list(n.values()), pa.int64())], ["k", "word", "n"])

    seen = work_table(sample.mapInArrow(count, "k int, word string, n long")
                      .groupBy("k", "word").agg(F.sum("n").alias("n")), "words")
    p = np.full((v + 2, len(languages)), 1.0 / v)
    p[v], p[v + 1] = 0.0, UNKNOWN
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(p)

        def step(batches, shared=shared):
            vocabulary, now = trie(path), shared.value
            total = np.zeros((now.shape[1], len(now)))
            for b in batches:  # rows of one word
                ks, ws, ns = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                for k in np.unique(ks):
                    at = np.flatnonzero(ks == k)
                    words = [MARK + ws[i] for i in at]
                    for part in by_length(words):
                        expected(vocabulary.lattice([words[i] for i in part]), now[:, k],
                                 ns[at[part]].astype(float), total[k])
            k, piece = np.nonzero(total[:, :v])
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[k, piece])],
                ["k", "piece", "c"])
            vocabulary = total = None
            give_back()

        # at most pieces x languages rows
        counts = (seen.mapInArrow(step, "k int, piece int, c double").groupBy("k", "piece")
                  .agg(F.sum("c").alias("c")).toPandas())
        c = np.full((v, len(languages)), SMOOTHING)
        c[counts["piece"], counts["k"]] += counts["c"]
        p = np.concatenate((c / c.sum(0), p[v:]))
        shared.unpersist()
    return LanguageModel(languages, p, path)


def scored(docs: DataFrame, model: LanguageModel, text_col: str, make, names: list[str], schema: str) -> DataFrame:
    """``make(batch, predictions)`` gives the output columns of each batch. Texts go to
    Python once, in slices bounded in bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        try:
            scorer = None
            for b in batches:
                scorer = scorer or Scorer(shared.value)
                for part in by_bytes(b, at):
                    columns = make(part, scorer.predict(part.column(at).to_pylist()))
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            scorer = None
            give_back()

    return docs.mapInArrow(run, schema)


def typed(fields) -> list[str]:
    return [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields]


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None,
            lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """The ``keep`` columns (all, if not given) with the predicted language and its score."""
    keep = docs.columns if keep is None else keep
    own = docs.select(*[col(c) for c in dict.fromkeys([*keep, text_col])])
    places = [own.columns.index(c) for c in keep]

    def make(part, got):
        return [*[part.column(k) for k in places], pa.array([UNDETERMINED if x is None else x for x, _ in got], pa.string()),
                pa.array([s for _, s in got], pa.float64())]

    schema = typed([own.schema[c] for c in keep]) + [f"`{lang_name}` string", f"`{score_name}` double"]
    return scored(own, model, text_col, make, [*keep, lang_name, score_name], ", ".join(schema))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, uid. Learns from the rows that are not held out."""
    out = held_out(col(id_col))
    model = train(docs, id_col, text_col, lang_col, learn_from=~out, **options)
    rows = with_uid(docs.select(col(id_col).alias("doc_id"), F.coalesce(out, F.lit(False)).alias("held_out"),
                                col(text_col).alias("text")), "uid")
    return predict(rows, model, keep=["doc_id", "held_out", "uid"])


def drop_undetermined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      **options) -> DataFrame:
    """The rows whose language is recognised, however sure and whatever it is called,
    with all their columns; only rows whose text has no letter go (all rows, if no
    row has a label to learn from)."""
    model = train(docs, id_col, text_col, lang_col, learn_from=~held_out(col(id_col)), **options)

    def make(part, got):
        return part.filter(pa.array([x is not None for x, _ in got], pa.bool_())).columns

    return scored(docs, model, text_col, make, docs.columns, ", ".join(typed(docs.schema.fields)))
