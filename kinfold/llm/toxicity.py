"""Toxic passages as maximum-scoring segments of token log-odds.

Learning counts, over all labelled texts, in how many toxic and clean texts each word form occurs: the whole word and
its first 4, 5 and 6 bytes, hashed to ``BUCKETS`` places. The log-odds of a form have an informative Dirichlet prior
(the counts of all texts scaled to ``prior`` texts), and a form scores by the lower end of its interval. A word
scores by its best form if that is above 0, else it costs ``DRIFT``. One linear scan finds all disjoint
maximum-scoring segments of a text. Segment scores of clean texts give the two parameters of the extreme-value law,
by which a segment's score becomes an expected number of equally good segments in a clean text of that length. A
logistic curve over that turns the best segment and the number of significant ones into a probability.

Every different labelled text counts; texts with the same sequence of words are one. A text that is much like ``n - 1``
others of its label weighs 1 / n, so near copies do not outvote other texts: they share one of ``ROUNDS`` least shingle
hashes with a leading text and agree with it in ``ALIKE`` of ``HASHES`` such hashes. Token scores that calibrate a text
come from the other half of the texts. The curve is fitted on a bounded sample of labelled texts (``sample``); counts
cover all of them.

Defined cases: a text without words has the score of no segment; a null or repeated label row with both values makes
the text toxic; without labels of both kinds every score is 0; repeated rows are scored each; other columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import NOT_LETTERS, Words, flat, fold, grams, map_batches, mix, passes, save, workspace
from kinfold.operators.skew import lookup

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
DRIFT = 0.25
PRIOR = 50.0
Z = 2.6
SAMPLE = 20_000
SIGNIFICANT = 0.01
FIRM = -math.log(SIGNIFICANT)
#: Sums closer than this count as equal where runs are cut.
NEAR = 1e-6
#: Least shingle hashes of a text, those by which texts meet, and those that must agree (a similarity of about 0.7).
HASHES = 32
ROUNDS = 4
ALIKE = 22
_ORDERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
#: Weight of a text without near copies; whole numbers make sums independent of their order.
WHOLE = 1 << 30


def _forms(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the texts, which of the different words each is, and the places of those: a row for each form."""
    words = Words(*flat(batch.column("text")), lower=True, separators=NOT_LETTERS)
    each, which = words.distinct()
    whole, first = each.prefix_hashes(PREFIXES)
    return words, which, (np.stack([whole, *first]) >> np.uint64(44)).astype(np.int64)


def _copies(batch: pa.RecordBatch) -> dict:
    """A digest of each text's whole sequence of words."""
    words = Words(*flat(batch.column("text")), lower=True)
    hashes = words.hashes()
    total = np.zeros(batch.num_rows, np.uint64)
    place = np.arange(len(hashes)) - words.bounds[words.doc]
    np.add.at(total, words.doc, mix(hashes + mix(place.astype(np.uint64) + np.uint64(1))))
    copy = mix(total + words.count.astype(np.uint64)).view(np.int64)
    return {"doc_id": batch.column("doc_id"), "copy": copy, "text": batch.column("text")}


def _keys(batch: pa.RecordBatch) -> dict:
    """The digests, and the least hashes of the runs of five words in ``HASHES`` orders; none in a shorter text."""
    words = Words(*flat(batch.column("text")), lower=True)
    hashes, at = grams(words.hashes(), words.bounds, 5)
    near: list = [[]] * batch.num_rows
    if len(at):
        doc = words.doc[at]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        least = np.stack([np.minimum.reduceat(hashes * a, first) >> np.uint64(32) for a in _ORDERS], 1)
        for i, row in zip(doc[first].tolist(), least.astype(np.uint32).view(np.int32), strict=True):
            near[i] = row
    return _copies(batch) | {"near": near}


def _count(batches):
    """Weight of the texts of each half and label in which a form occurs."""
    counts = np.zeros((4, BUCKETS), np.int64)
    texts = np.zeros(4, np.int64)
    for batch in passes(batches):
        words, which, forms = _forms(batch)
        half, toxic = (batch.column(c).to_numpy().astype(np.int64) for c in ("half", "toxic"))
        kind = half * 2 + toxic
        weight = WHOLE // batch.column("alike").to_numpy()
        np.add.at(texts, kind, weight)
        used = max(forms.shape[1], 1)
        once = np.unique(words.doc * used + which)
        pair = np.unique(np.concatenate([once // used * BUCKETS + f[once % used] for f in forms]))
        place = kind[pair // BUCKETS] * BUCKETS + pair % BUCKETS
        np.add.at(counts.reshape(-1), place, weight[pair // BUCKETS])
    used = np.flatnonzero(counts.any(axis=0))
    columns = [np.concatenate([[texts[i]], counts[i, used]]) for i in range(4)]
    names = ["place", "c0", "c1", "c2", "c3"]
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], used])), *map(pa.array, columns)], names=names)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, prior: float = PRIOR, z: float = Z) -> np.ndarray:
    """Lower end of the log-odds of each form under a Dirichlet prior of ``prior`` texts."""
    pull = prior * (toxic + clean) / max(n_toxic + n_clean, 1) + 1e-3
    a, b = toxic + pull, clean + pull
    odds = np.log(a / np.maximum(n_toxic + prior - a, 1e-3)) - np.log(b / np.maximum(n_clean + prior - b, 1e-3))
    return np.where(toxic > 0, odds - z * np.sqrt(1 / a + 1 / b), 0.0).clip(0).astype(np.float32)


def segments(at: np.ndarray, gain: np.ndarray, drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first word, last word)`` where words at ``at`` gain and others cost."""
    after = np.cumsum(gain) - drift * (at - np.arange(len(at)))
    found: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, last
    for place, low, high in zip(at.tolist(), (after - gain).tolist(), after.tolist(), strict=True):
        first = place
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][0] >= low:
                k -= 1
            if k < 0 or found[k][1] >= high:
                found.append((low, high, first, place))
                break
            low, first = found[k][0], found[k][2]
            del found[k:]
    return [(high - low, first, last) for low, high, first, last in found]


def excursions(at: np.ndarray, gain: np.ndarray, text: np.ndarray, drift: float = DRIFT) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of scoring words begin that no maximal segment crosses, and the score that each can reach at most.

    A run ends where the sum falls to its lowest so far in the ``text``: a segment's sums stay above that before it.
    ``at`` are places among the words of all texts, in order.
    """
    after = np.cumsum(gain) - drift * (at - np.arange(len(at)))
    before = after - gain
    head = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    turn = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(at))))
    before, after = before - before[head][turn], after - before[head][turn]
    # Each text lies below the one before it, so that one running minimum serves all.
    fall = turn * (float(after.max()) - float(before.min()) + 1.0)
    lowest = np.minimum.accumulate(before - fall)
    start = np.concatenate([[True], before[1:] - fall[1:] <= lowest[:-1] - NEAR])
    start[head] = True
    start = np.flatnonzero(start)
    return start, np.maximum.reduceat(after, start) - np.minimum.reduceat(before, start)


class Scorer:
    """Segments of a batch of texts under a table of form scores."""

    def __init__(self, batch: pa.RecordBatch, table: np.ndarray, half: np.ndarray | None = None):
        """``table`` has a row of scores for each half; without ``half`` its only row is used."""
        self.words, which, forms = _forms(batch)
        best = np.stack([row[forms].max(axis=0) for row in table])
        best = best[0, which] if half is None else best[half[self.words.doc], which]
        self.at = np.flatnonzero(best > 0)
        self.gain = best[self.at].astype(np.float64)
        self.text = self.words.doc[self.at]

    def segments(self, floor: np.ndarray | None = None) -> list[list[tuple[float, int, int]]]:
        """Maximal segments of each text; with a ``floor`` for each text at least all that reach it."""
        found: list[list] = [[] for _ in self.words.count]
        if not len(self.at):
            return found
        start, most = excursions(self.at, self.gain, self.text)
        cut = np.append(start, len(self.at))
        text = self.text[start]
        use = np.arange(len(start)) if floor is None else np.flatnonzero(most >= floor[text] - NEAR)
        for i, low, high in zip(text[use].tolist(), cut[use].tolist(), cut[use + 1].tolist(), strict=True):
            found[i] += segments(self.at[low:high] - self.words.bounds[i], self.gain[low:high])
        return found


def _calibration(tables: np.ndarray):
    """Words and segment scores of each text; a batch's first text also has the gains in its clean texts and their weight."""

    def make(batch: pa.RecordBatch) -> dict:
        scorer = Scorer(batch, tables, batch.column("half").to_numpy().astype(np.int64))
        scores = [[s for s, _, _ in x] for x in scorer.segments()]
        weight = np.where(batch.column("toxic").to_numpy() == 0, 1 / batch.column("alike").to_numpy(), 0.0)
        gains, which = np.unique(scorer.gain, return_inverse=True)
        times = np.bincount(which, weight[scorer.text], minlength=len(gains))
        none: list = [[]] * (batch.num_rows - 1)
        return {
            "row_id": batch.column("row_id"), "toxic": batch.column("toxic"), "alike": batch.column("alike"), "words": scorer.words.count,
            "scores": scores, "gains": [gains, *none], "times": [times, *none],
        }

    return make


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    return np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])


class Law:
    """Extreme-value law of segment scores in clean texts, and the curve from evidence to probability."""

    def __init__(self, words: np.ndarray, gains: np.ndarray, times: np.ndarray, scores: list, toxic: np.ndarray, weight: np.ndarray):
        """``times`` is the weight of the clean texts' words with each of ``gains``."""
        clean = np.flatnonzero(~toxic)
        total = max(float((words * weight)[clean].sum()), 1.0)
        ups, which = np.unique(gains, return_inverse=True)
        times = np.append(np.bincount(which, times, minlength=len(ups)), 1.0)
        low, high = 0.0, 1.0
        # The decay is the positive root of the mean of exp(decay * score) - 1 over words of clean texts; an
        # added word of the highest score keeps it finite where clean texts have none.
        ups = np.append(ups, ups.max(initial=8.0))

        def excess(decay: float) -> float:
            return float((total - times.sum() + 1) * np.exp(-decay * DRIFT) + (times * np.exp(decay * ups)).sum() - (total + 1))

        while excess(high) < 0 and high < 64:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if excess(middle) < 0 else (low, middle)
        self.decay = max(low, 1e-3)
        best = np.array([max(s, default=0.0) for s in scores])
        self.rate = (float(weight[clean].sum()) + 1) / (float(((weight * words)[clean] * np.exp(-self.decay * best[clean])).sum()) + 1)
        x = np.array([self.evidence(s, n) for s, n in zip(scores, words, strict=True)])
        self.slope, self.shift = _logistic(x, toxic.astype(float), weight)

    def evidence(self, scores: list[float], words: int) -> float:
        """Minus the log of the expected number of segments as good as the best, and a share for further ones."""
        if not len(scores):
            return 0.0
        each = [self.significance(s, words) for s in scores]
        further = sum(e > FIRM for e in each)
        return math.log1p(max(0.0, max(each)) + max(0, further - 1))

    def significance(self, score: float, words: int) -> float:
        return self.decay * score - math.log(self.rate * max(words, 1))

    def floor(self, words: np.ndarray) -> np.ndarray:
        """Scores below which a segment of a text is no evidence."""
        return np.log(self.rate * np.maximum(words, 1)) / self.decay

    def probability(self, scores: list[float], words: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.evidence(scores, words) + self.shift, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 0.1) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton's method."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    design, weight = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        curve = design.T @ (design * (times * p * (1 - p))[:, None]) + np.eye(2) * penalty
        weight = weight - np.linalg.solve(curve, design.T @ (times * (p - y)) + penalty * weight)
    return max(weight[0], 0.0) / scale, weight[1]


class Model:
    def __init__(self, table: np.ndarray, law: Law):
        self.table, self.law = table, law


def _alike(one: DataFrame, scratch) -> DataFrame:
    """``copy``, ``toxic`` and how many texts of that label are ``alike``, for texts that are much like a leading one."""
    group = ["toxic", "round", "key"]
    sides = one.select("copy", "toxic", "near", F.posexplode(F.slice("near", 1, ROUNDS)).alias("round", "key"))
    leaders = sides.groupBy(*group).agg(F.min_by("near", "copy").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    total = one.count() * ROUNDS
    same = F.expr(f"size(filter(zip_with(near, leader, (a, b) -> a = b), x -> x)) >= {ALIKE}")
    near = save(scratch, lookup(sides, leaders, group, "n", total).filter(same).select("copy", *group), "near")
    sizes = near.groupBy(*group).agg(F.count("*").alias("n")).withColumn("alike", F.col("n"))
    return lookup(near, sizes, group, "n", total).groupBy("copy", "toxic").agg(F.max("alike").alias("alike"))


def labelled_texts(docs: DataFrame, marks: DataFrame, scratch) -> DataFrame:
    """Every different labelled text once, with its half and how many texts are ``alike``.

    One text stands for all with its words and label. It is chosen among ids and keys alone, so texts are shuffled once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = map_batches(rows, _keys, f"doc_id {kind}, copy long, near array<int>")
    marked = keys.join(marks.hint("merge"), F.col("doc_id") == F.col("labelled_id"))
    one = marked.groupBy("copy", "toxic").agg(F.min("doc_id").alias("doc_id"), F.first("near").alias("near"))
    one = save(scratch, one, "copies")
    chosen = one.select("copy", "toxic", "doc_id", F.coalesce(F.get("near", F.lit(0)).cast("long"), "copy").alias("key"))
    chosen = chosen.join(_alike(one, scratch), ["copy", "toxic"], "left").fillna(1, ["alike"])
    texts = map_batches(rows, _copies, f"doc_id {kind}, copy long, text string").join(chosen.hint("merge"), ["doc_id", "copy"])
    texts = texts.dropDuplicates(["doc_id", "copy"]).select(
        F.xxhash64("copy", "toxic").alias("row_id"), F.col("toxic").cast("int").alias("toxic"), "text", "alike",
        F.pmod(F.xxhash64("key"), F.lit(2)).cast("int").alias("half"),
    )
    return save(scratch, texts, "distinct")


def form_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the forms of toxic texts, the weight of texts with each by half and label, and that of all texts."""
    counted = texts.mapInArrow(_count, "place long, c0 long, c1 long, c2 long, c3 long")
    sums = counted.groupBy("place").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)])
    counts = sums.filter("place < 0 or c1 > 0 or c3 > 0").toArrow()  # at most BUCKETS + 1 rows; other forms score 0
    place = counts["place"].to_numpy()
    weights = np.stack([counts[f"c{i}"].to_numpy() for i in range(4)]) / WHOLE
    return place[place >= 0], weights[:, place >= 0], weights[:, place < 0].sum(1)


def learn(docs: DataFrame, marks: DataFrame, scratch, sample: int = SAMPLE) -> Model | None:
    """A model from ``doc_id`` and ``text``, and ``labelled_id`` and ``toxic`` (0 or 1) once per id; None without
    texts of both kinds.
    """
    texts = labelled_texts(docs, marks, scratch)
    place, weights, texts_of = form_counts(texts)
    clean, toxic = weights[[0, 2]], weights[[1, 3]]
    n_clean, n_toxic = texts_of[[0, 2]], texts_of[[1, 3]]
    if not n_clean.sum() or not n_toxic.sum():
        return None

    def scores(of: list[int]) -> np.ndarray:
        table = np.zeros(BUCKETS, np.float32)
        table[place] = log_odds(toxic[of].sum(0), clean[of].sum(0), n_toxic[of].sum(), n_clean[of].sum())
        return table

    whole = scores([0, 1])
    # Texts of one half are scored by the counts of the other.
    halves = np.stack([scores([1]), scores([0])])
    del place, weights, clean, toxic
    pa.default_memory_pool().release_unused()
    some = texts.select("row_id").orderBy("row_id").limit(sample)
    chosen = texts.join(F.broadcast(some), "row_id", "left_semi")  # at most ``sample`` numbers
    seen = map_batches(chosen, _calibration(halves), "row_id long, toxic int, alike long, words long, scores array<double>, gains array<double>, times array<double>")
    rows = seen.toArrow()
    gains, times = (rows[c].combine_chunks().flatten().to_numpy() for c in ("gains", "times"))
    law = Law(rows["words"].to_numpy(), gains, times, _lists(rows["scores"]), rows["toxic"].to_numpy() == 1, 1 / rows["alike"].to_numpy())
    return Model(whole[None], law)


SCORED = "score double, n_words long, passages array<struct<first_word:int,last_word:int,significance:double>>"


def _score(model: Model | None, kept: list[str]):
    def make(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in kept}
        if model is None:
            return out | {"score": np.zeros(batch.num_rows), "n_words": np.zeros(batch.num_rows, np.int64), "passages": [[]] * batch.num_rows}
        scorer = Scorer(batch, model.table)
        law, scores, passages = model.law, [], []
        nothing = law.probability([], 0)
        for n, found in zip(scorer.words.count.tolist(), scorer.segments(law.floor(scorer.words.count)), strict=True):
            scores.append(law.probability([s for s, _, _ in found], n) if found else nothing)
            each = [(a, b, law.significance(s, n)) for s, a, b in found]
            passages.append([{"first_word": a, "last_word": b, "significance": e} for a, b, e in each if e > FIRM])
        return out | {"score": scores, "n_words": scorer.words.count, "passages": passages}

    return make


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``score``, ``n_words`` and the significant toxic ``passages`` (positions among runs of letters).

    Rows with ``crc32(doc_id) mod parts = held`` lend no label. Columns of ``docs`` with those names are replaced.
    """
    scratch = workspace(docs.sparkSession, "toxicity")
    marks = labels.filter("toxic in (0, 1)").groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").alias("toxic"))
    known = docs.select("doc_id", "text").filter(fold("doc_id", parts) != held)
    model = learn(known, marks, scratch, sample)
    kept = [c for c in docs.columns if c.lower() not in ("score", "n_words", "passages")]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in kept]).schema)
    return map_batches(docs.select(*[F.col(f"`{c}`") for c in kept]), _score(model, kept), f"{ddl}, {SCORED}")
