"""Toxicity by a weighted finite-state pattern grammar (operator 9).

A lexicon maps words to classes: insult, threat, target, negation, reported
speech.  Insults are learned from labelled documents, as words or as stems
(word beginnings); the other classes are short word lists of the documents'
languages.  Small transducers read the classes of a clause from left to right:
one tracks what a negation still covers, one whether the clause reports
speech, one how far back a target is, and one a threat that waits for its
target.  Their composition is a single machine, which writes one pattern for
each insult or threat, such as a targeted or a negated one.  A clause counts
by its matched patterns and the words' weights, not by isolated words, and the
weight of each pattern is fitted to the labels by logistic regression: one
scale times what the pattern suggests, plus a small difference of its own.

Learning uses at most ``SAMPLE_DOCS`` labelled documents outside the held-out
fold, half of each label, whole texts; they are stored once, so the table is read
twice in all, for them and for the scores.  Words of any length are counted, and
an entry needs a clear excess of toxic documents by a test that Spark applies to
all of them.  Near copies (by their minhashes) count once in every count, so that
the other words of a copied text are not taken for insults.  What the driver holds
is bounded by the sample: a signature and a vector of pattern values for each
document, and the entries that passed the test.  Scoring is a map over whole texts.

Null and empty texts match nothing and get the score of no match.  Without
labels of both kinds there are no learned insults, and the smoothed share of
label 1 is the score of a text without a match.  Equal texts get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.labelled import fold, labelled_texts, sample_labels
from cadence.llm.text import as_bytes, bound_batches, mix, only, with_fields
from cadence.session import delete_path, materialise

SAMPLE_DOCS = 8000
FOLDS, HELD_OUT = 5, 0
STEM_SIZES = range(3, 9)
# An entry is that many times as frequent in toxic documents as in clean ones.
CLEAN_TIMES = 200
# Signatures of near copies: hashes, hashes in a band, and the share that must agree.
SIGNATURE, BAND, ALIKE = 32, 4, 0.7
WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:\n]+")

# Word lists of the grammar's closed classes (English, German, French, Spanish).
NEGATIONS = "not no never none nor without nicht kein keine nie ohne ne pas jamais sans nunca ni sin".split()
TARGETS = ("you your yours he she they them him her people du ihr sie dich dir euch er tu vous toi "
           "il elle ils elles usted ustedes él ella ellos ellas").split()
REPORTS = ("said says say called calls wrote writes told quoted reported sagte sagt nannte schrieb "
           "zitierte dit disait écrit appelé dijo dice llamó escribió").split()
THREATS = ("kill hurt destroy shoot murder beat strangle töten umbringen schlagen tuer frapper "
           "détruire matar golpear destruir").split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult threat target negation report other".split()
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)
CLOSED = {w: s for s, words in ((NEGATION, NEGATIONS), (TARGET, TARGETS), (REPORT, REPORTS),
                                (THREAT, THREATS)) for w in words}


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol) -> (state, output); an output is a set of marks."""

    start: object
    arcs: dict

    def compose(self, other: "Transducer") -> "Transducer":
        """The machine that runs both over the same symbols and joins their marks."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        while todo:
            state = todo.pop()
            for symbol in SYMBOLS:
                (left, mine), (right, theirs) = self.arcs[state[0], symbol], other.arcs[state[1], symbol]
                arcs[state, symbol] = ((left, right), mine | theirs)
                if (left, right) not in seen:
                    seen.add((left, right))
                    todo.append((left, right))
        return Transducer(start, arcs)


def _countdown(opens: str, reach: int, mark: str, at: tuple[str, ...]) -> Transducer:
    """Marks the symbols ``at`` that stand within ``reach`` words after ``opens``."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in SYMBOLS:
            out = frozenset([mark]) if left and symbol in at else frozenset()
            arcs[left, symbol] = (reach if symbol == opens else max(0, left - 1), out)
    return Transducer(0, arcs)


def _pattern_writer() -> Transducer:
    """Marks every insult, and every target that a threat waits for."""
    arcs = {}
    for waits in range(5):
        for symbol in SYMBOLS:
            out = frozenset([INSULT] if symbol == INSULT else
                            [THREAT] if symbol == TARGET and waits else [])
            arcs[waits, symbol] = (4 if symbol == THREAT else max(0, waits - 1), out)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    return (_pattern_writer()
            .compose(_countdown(NEGATION, 4, NEGATION, (INSULT, TARGET)))
            .compose(_countdown(REPORT, 1 << 6, REPORT, (INSULT, TARGET)))
            .compose(_countdown(TARGET, 5, TARGET, (INSULT,))))


def _patterns() -> list[frozenset]:
    out = []
    for main, marks in ((INSULT, (NEGATION, REPORT, TARGET)), (THREAT, (NEGATION, REPORT))):
        for bits in range(1 << len(marks)):
            out.append(frozenset([main] + [m for i, m in enumerate(marks) if bits >> i & 1]))
    return out


PATTERNS = _patterns()
_AT = {p: i for i, p in enumerate(PATTERNS)}


def _ratio(pattern: frozenset) -> float:
    """How much a pattern weighs against a plain insult before any label is seen."""
    return (1.25 if TARGET in pattern else 1) * (0.6 if NEGATION in pattern else 1) \
        * (0.6 if REPORT in pattern else 1)


class Matcher:
    """Runs the composed machine over the clauses that hold an insult or a threat."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        import ahocorasick

        self.words, self.stems = words, stems
        self.machine = grammar()
        self.finder = ahocorasick.Automaton()
        for entry in {*words, *stems, *THREATS}:
            self.finder.add_word(entry, (len(entry), entry in stems, entry))
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for size in STEM_SIZES:
            if size > len(word):
                break
            found = max(found, self.stems.get(word[:size], 0.0))
        return found

    def _places(self, text: str) -> list[int]:
        """Where insults or threats begin in a lower-cased text."""
        found = []
        for end, (size, stem, entry) in self.finder.iter(text):
            begin = end - size + 1
            if begin and WORD.match(text[begin - 1]):
                continue
            if not stem or entry in self.words:
                follows = text[end + 1:end + 2]
                if not stem and follows and WORD.match(follows):
                    continue
            found.append(begin)
        return sorted(found)

    def values(self, text: str) -> np.ndarray:
        """For each pattern 1 - exp(-sum of the weights of its matches)."""
        sums = np.zeros(len(PATTERNS))
        text = text.lower()
        places = self._places(text)
        at = 0
        for clause in CLAUSE.finditer(text) if places else ():
            while at < len(places) and places[at] < clause.start():
                at += 1
            if at == len(places):
                break
            if places[at] < clause.end():
                self._clause(clause.group(), sums)
        return 1 - np.exp(-sums)

    def _clause(self, clause: str, sums: np.ndarray) -> None:
        state = self.machine.start
        for word in WORD.findall(clause):
            weight = self.weight(word)
            symbol = INSULT if weight else CLOSED.get(word, OTHER)
            state, marks = self.machine.arcs[state, symbol]
            if INSULT in marks or THREAT in marks:
                sums[_AT[marks - {TARGET} if THREAT in marks else marks]] += weight or 3.0


@dataclass(frozen=True)
class Model:
    words: dict
    stems: dict
    weights: np.ndarray
    bias: float


def _signatures(texts: DataFrame) -> DataFrame:
    """(id, label, signature): the smallest hashes of each text's set of words."""
    seeds = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            found = []
            for raw in as_bytes(batch.column(1)):
                words = set(WORD.findall(raw.decode().lower())) or {""}
                hashes = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words))
                least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
                for i in range(0, len(hashes), 4096):
                    part = mix(hashes[None, i:i + 4096] ^ seeds[:, None])
                    least = np.minimum(least, part.min(axis=1))
                found.append(least.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())],
                                             ["id", "label", "signature"])

    return texts.mapInArrow(run, "id string, label int, signature binary")


def copy_groups(signatures: list[bytes]) -> list[int]:
    """A number for each signature, equal for near copies (and what they lead to)."""
    rows = np.frombuffer(b"".join(signatures), np.uint64).reshape(len(signatures), SIGNATURE)
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for first in range(0, SIGNATURE, BAND):
        # One member of each group that a bucket holds is enough to compare with.
        buckets: dict[bytes, list[int]] = {}
        for i, row in enumerate(rows):
            bucket = buckets.setdefault(row[first:first + BAND].tobytes(), [])
            for j in bucket:
                if find(i) != find(j) and (row == rows[j]).mean() >= ALIKE:
                    root[max(find(i), find(j))] = min(find(i), find(j))
            if find(i) not in {find(j) for j in bucket}:
                bucket.append(i)
    return [find(i) for i in range(len(rows))]


def _word_counts(texts: DataFrame, group: dict[str, int]) -> DataFrame:
    """(entry, stem, toxic, clean): the groups of near copies with each entry, over (id, text, label)."""
    def run(batches):
        held: dict[tuple[str, bool], list] = {}
        for batch in batches:
            for key, raw, label in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)),
                                       batch.column(2).to_pylist()):
                words = set(WORD.findall(raw.decode().lower()))
                entries = {(w, False) for w in words}
                entries |= {(w[:k], True) for w in words for k in STEM_SIZES if k < len(w)}
                for entry in entries:
                    held.setdefault(entry, [set(), set()])[label].add(group[key])
        names = ["entry", "stem", "toxic", "clean"]
        items = list(held.items())
        for i in range(0, len(items), 100_000):
            part = items[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part], pa.string()), pa.array([k[1] for k, _ in part], pa.bool_()),
                 pa.array([list(v[1]) for _, v in part], pa.list_(pa.int64())),
                 pa.array([list(v[0]) for _, v in part], pa.list_(pa.int64()))], names)

    counted = texts.mapInArrow(run, "entry string, stem boolean, toxic array<bigint>, clean array<bigint>")
    distinct = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return counted.groupBy("entry", "stem").agg(distinct("toxic"), distinct("clean"))


def _excess(counts: DataFrame, n_toxic: int, n_clean: int, surprise: float, least: int) -> list:
    """The entries with a clear excess of toxic documents.

    The test is a bound (Chernoff) on the chance that so few of an entry's documents
    are clean: minus its logarithm must reach ``surprise``.
    """
    rate = (n_toxic + 1) / (n_toxic + n_clean + 2)
    n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    tail = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    bound = F.when(share > rate, n * (share * F.log(share / rate) + tail)).otherwise(0.0)
    return counts.where(F.col("toxic") >= least) \
        .where(F.col("clean").cast("bigint") * n_toxic * CLEAN_TIMES <= F.col("toxic").cast("bigint") * n_clean) \
        .where(bound >= surprise).collect()


def _choose(good: list, n_toxic: int, n_clean: int) -> tuple[dict, dict]:
    """Words and stems of the entries that passed the test, with their log-odds weights."""
    weight = {(r.entry, r.stem): math.log((r.toxic + 0.5) / (n_toxic + 1))
              - math.log((r.clean + 0.5) / (n_clean + 1)) for r in good}
    count = {(r.entry, r.stem): r.toxic for r in good}
    words = {e for e, stem in count if not stem}
    stems: dict[str, float] = {}
    best_word: dict[str, int] = {}
    for w in words:
        for k in STEM_SIZES:
            if k <= len(w):
                best_word[w[:k]] = max(best_word.get(w[:k], 0), count[w, False])
    for entry in sorted((e for e, stem in count if stem), key=lambda e: (len(e), e)):
        if any(entry.startswith(s) for s in stems):
            continue
        n = count[entry, True]
        # A stem must cover clearly more than its most frequent word, and is
        # taken as long as a longer one covers nearly the same documents.
        longer = max((count[e, True] for e in (x for x, stem in count if stem)
                      if len(e) == len(entry) + 1 and e.startswith(entry)), default=0)
        if n >= 1.2 * best_word.get(entry, 0) and longer < 0.98 * n:
            stems[entry] = weight[entry, True]
    kept = {w: weight[w, False] for w in words if not any(w.startswith(s) for s in stems)}
    return kept, stems


def _fit_weights(x: np.ndarray, y: np.ndarray, hold: float = 1e-3, hold_own: float = 2e-2) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps: a scale that all patterns share, and
    each pattern's own difference, which is held towards nothing."""
    ratios = np.array([_ratio(p) for p in PATTERNS])
    prior = np.array([4.0] + [0.0] * len(PATTERNS) + [-2.0])
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return prior[0] * ratios, float(np.log(share / (1 - share)))
    x = np.hstack([(x @ ratios)[:, None], x, np.ones((len(x), 1))])
    weight = len(y) / (2.0 * np.where(y == 1, y.sum(), len(y) - y.sum()))
    hold = np.array([hold] + [hold_own] * len(PATTERNS) + [hold])
    w = prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) / len(y) + hold * (w - prior)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[0] * ratios + w[1:-1], float(w[-1])


def _values(texts: DataFrame, words: dict, stems: dict) -> DataFrame:
    """(id, label, values) of each row of (id, text, label)."""
    def run(batches):
        matcher = Matcher(words, stems)
        for batch in batches:
            found = [matcher.values(t.decode()) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))],
                ["id", "label", "values"])

    return texts.mapInArrow(run, "id string, label int, values array<double>")


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", folds: int = FOLDS,
        held_out: int = HELD_OUT, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Learn insults and pattern weights from a bounded sample of the labelled documents."""
    spark = docs.sparkSession
    bound_batches(spark)
    sample = sample_labels(labels, target, folds, held_out, sample_docs, id_col)
    picked = labelled_texts(docs, sample, id_col, text_col)
    texts, path = materialise(picked.select(F.col(id_col).cast("string").alias("id"),
                                            F.col(text_col).alias("text"), "label"), "toxic-sample")
    try:
        return _learn(texts)
    finally:
        delete_path(spark, path)


def _learn(texts: DataFrame) -> Model:
    """Learn from (id, text, label), one row for each id."""
    words: dict[str, float] = {}
    stems: dict[str, float] = {}

    def observed():
        rows = _values(texts, words, stems).collect()  # bounded by the sample
        return np.array([r["values"] for r in rows]).reshape(-1, len(PATTERNS)), rows

    signed = sorted(_signatures(texts).collect(), key=lambda r: r.id)  # bounded by the sample
    group = dict(zip([r.id for r in signed], copy_groups([r.signature for r in signed])))
    n = [len({group[r.id] for r in signed if r.label == label}) for label in (0, 1)]
    x, rows = observed()
    if all(n):
        found = _excess(_word_counts(texts, group), n[1], n[0], 16.0 + math.log(1 + n[1]), max(3, n[1] // 100))
        words, stems = _choose(found, n[1], n[0])
        x, rows = observed()
        # Toxic documents that no entry explains yet, if there are several, may
        # hold rarer insults: learn from these and the clean ones once more.
        silent = x.sum(axis=1) == 0
        rest = len({group[r.id] for r, nothing in zip(rows, silent) if nothing and r.label == 1})
        if rest >= 3:
            found = _excess(_word_counts(_unmatched(texts, words, stems), group), rest, n[0], 8.0, 3)
            more, more_stems = _choose(found, rest, n[0])
            words, stems = words | more, stems | more_stems
            x, rows = observed()
    weights, bias = _fit_weights(x, np.array([r.label for r in rows]))
    return Model(words, stems, weights, bias)


def _unmatched(texts: DataFrame, words: dict, stems: dict) -> DataFrame:
    """The clean documents, and the toxic ones without a match."""
    def run(batches):
        matcher = Matcher(words, stems)
        for batch in batches:
            keep = [label == 0 or not matcher.values(t.decode()).any()
                    for t, label in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return texts.mapInArrow(run, texts.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, *keep, score): the probability of label 1 for every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        matcher = Matcher(m.words, m.stems)
        for batch in batches:
            x = np.array([matcher.values(t.decode()) for t in as_bytes(batch.column(1))])
            logits = x.reshape(-1, len(PATTERNS)) @ m.weights + m.bias
            scores = 1 / (1 + np.exp(-np.clip(logits, -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             [*batch.schema.names, "score"])

    rows = only(docs, id_col, text_col, *keep)
    return rows.mapInArrow(run, with_fields(rows, score="double"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (),
                    sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, text, *keep, held_out, score, predicted) for every document."""
    scored = score(docs, fit(docs, labels, sample_docs=sample_docs), keep=keep)
    return scored.select(*[c for c in scored.columns if c != "score"],
                         F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
