"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased, every run of other characters than letters becomes one space, and characters are read in runs of
four. The counts of such runs in all learning texts are summed by Spark for each language. From them follow the
continuation counts of the lower orders (how many different characters stand before a run), one discount for each
order, and the interpolated probabilities. A language's model is a set of sorted arrays of run codes with a value
each; a batch looks up each different run once. A text gets the language of least cross-entropy per character. Its
score is the posterior at a temperature fitted on a bounded sample, lowered when the text is far less likely than texts
of that language usually are; below ``reject`` the language is ``und``.

A model holds every run of its language. Each language is a broadcast of its own; a worker holds all of them if they have
at most ``entries`` runs of four in all, else one at a time, read again for each batch. The result is the same.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing can be
learned; ties go to the language that sorts first; characters beyond U+FFFF count by their low 16 bits; repeated rows
are judged each; other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import fold, map_batches, passes, save, workspace

ENTRIES = 1 << 20
SAMPLE = 2_000
SPACE = np.uint64(0x20)
UNKNOWN = "und"
_LOW = np.uint64(16)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code of the four characters that end at each kept character, and ``n + 1`` bounds of the texts."""
    texts = [t.lower() if t else "" for t in column.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    letter = _letters()[points]
    after = np.zeros(len(points), bool)
    after[1:] = letter[:-1]
    after[offsets[:-1][offsets[:-1] < len(points)]] = False
    keep = letter | after
    total = np.concatenate([[0], np.cumsum(keep)])
    bounds = total[offsets]
    chars = np.where(letter, points & 0xFFFF, 0x20)[keep].astype(np.uint64)
    code = chars.copy()
    starts = bounds[:-1][bounds[1:] > bounds[:-1]]
    place = np.arange(len(chars)) - np.repeat(starts, np.diff(bounds)[bounds[1:] > bounds[:-1]])
    for back in (1, 2, 3):
        before = np.concatenate([np.full(min(back, len(chars)), SPACE), chars[: max(len(chars) - back, 0)]])
        code |= np.where(place >= back, before, SPACE) << np.uint64(16 * back)
    return code, bounds


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def _count(batches):
    """Counts of runs for each language, merged before they leave the task."""
    found: dict[str, list] = {}
    held = 0
    for batch in passes(batches):
        code, bounds = runs(batch.column("text"))
        lang = np.array(batch.column("lang").to_pylist(), object)
        of = np.repeat(lang, np.diff(bounds))
        for name in sorted(set(lang)):
            part = np.unique(code[of == name], return_counts=True)
            found.setdefault(name, []).append(part)
            held += len(part[0])
        if held > 2_000_000:
            found = {k: [_merge(v)] for k, v in found.items()}
            held = sum(len(v[0][0]) for v in found.values())
            if held > 1_000_000:
                yield from _rows(found)
                found, held = {}, 0
    yield from _rows(found)


def _rows(found: dict):
    for name, parts in found.items():
        codes, n = _merge(parts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "code", "n"])


class KneserNey:
    """One language. For each order, sorted codes with log probabilities and sorted contexts with log weights."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.levels = []
        seen, times = codes[order], counts[order].astype(float)
        stages = [(seen, times)]
        for n in (3, 2, 1):
            seen, times = np.unique(stages[-1][0] & np.uint64((1 << (16 * n)) - 1), return_counts=True)
            stages.append((seen, times.astype(float)))
        alphabet = len(stages[-1][0]) + 1
        lower = None
        for n, (seen, times) in zip((1, 2, 3, 4), reversed(stages), strict=True):
            ones, twos = (times == 1).sum(), (times == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            context, first = np.unique(seen >> _LOW, return_inverse=True)
            total = np.bincount(first, times)
            weight = np.bincount(first, np.minimum(times, discount)) / total
            base = np.full(len(seen), 1 / alphabet) if lower is None else np.exp(self._log(seen & np.uint64((1 << (16 * (n - 1))) - 1), n - 1))
            p = np.maximum(times - discount, 0) / total[first] + weight[first] * base
            self.levels.append((seen, np.log(p), context, np.log(weight)))
            lower = n
        self.floor = -np.log(alphabet)

    def _log(self, codes: np.ndarray, n: int) -> np.ndarray:
        """Log probability of the last character of runs of ``n``."""
        if n == 0:
            return np.full(len(codes), self.floor)
        seen, log_p, context, weight = self.levels[n - 1]
        at = np.minimum(np.searchsorted(seen, codes), len(seen) - 1)
        hit = seen[at] == codes
        out = log_p[at]
        if not hit.all():
            miss = codes[~hit]
            before = miss >> _LOW
            place = np.minimum(np.searchsorted(context, before), len(context) - 1)
            back = np.where(context[place] == before, weight[place], 0.0)
            floor = getattr(self, "floor", -np.log(len(self.levels[0][0]) + 1))
            rest = miss & np.uint64((1 << (16 * (n - 1))) - 1)
            out[~hit] = back + (self._log(rest, n - 1) if n > 1 else floor)
        return out

    def log(self, codes: np.ndarray) -> np.ndarray:
        return self._log(codes, 4)


class Model:
    def __init__(self, languages: list[str], models: list, held: bool):
        """``models`` are broadcasts of ``KneserNey``, kept in memory between batches if ``held``."""
        self.languages, self.models, self.held = languages, models, held
        self.temperature = 0.1
        self.usual = np.zeros((len(languages), 2))

    def entropies(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text under each language, and the number of characters."""
        code, bounds = runs(column)
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.models)))
        full = np.flatnonzero(n)
        if len(full):
            different, place = np.unique(code, return_inverse=True)
            for i, model in enumerate(self.models):
                out[full, i] = -np.add.reduceat(model.value.log(different)[place], bounds[full]) / n[full]
                if not self.held:
                    vars(model).pop("_value", None)  # what a broadcast keeps of its file
        return out, n

    def judge(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, its score, and the number of characters."""
        entropy, n = self.entropies(column)
        best = entropy.argmin(1)
        gap = (entropy - entropy.min(1, keepdims=True)) * n[:, None] * self.temperature
        posterior = 1 / np.exp(-np.minimum(gap, 500)).sum(1)
        mean, spread = self.usual[best].T
        far = (entropy.min(1) - mean) / np.maximum(spread, 0.05) * np.sqrt(np.minimum(n, 50) / 50)
        return best, posterior / (1 + np.exp(np.clip(far - 8, -30, 30))), n


def _entropies(model: Model):
    def make(batch: pa.RecordBatch) -> dict:
        entropy, n = model.entropies(batch.column("text"))
        return {"lang": batch.column("lang"), "n": n, "entropy": list(entropy)}

    return make


def _groups(languages: list[str], size_of: dict, entries: int) -> list[list[str]]:
    """Languages in order, together while they have at most ``entries`` runs; each at least alone."""
    groups: list[list[str]] = []
    total = 0
    for x in languages:
        if not groups or total + size_of[x] > entries:
            groups.append([])
            total = 0
        groups[-1].append(x)
        total += size_of[x]
    return groups


def learn(known: DataFrame, scratch, entries: int = ENTRIES, sample: int = SAMPLE) -> Model | None:
    """A model from the columns ``text`` and ``lang``."""
    counted = known.mapInArrow(_count, "lang string, code long, n long")
    counts = save(scratch, counted.groupBy("lang", "code").agg(F.sum("n").alias("n")), "runs")
    size_of = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
    if not size_of:
        return None
    languages, models = sorted(size_of), []
    for group in _groups(languages, size_of, entries):
        number = F.array_position(F.array(*[F.lit(x) for x in group]), F.col("lang")).cast("int")
        rows = counts.select(number.alias("of"), "code", "n").filter("of > 0").toArrow()
        of, code, n = rows["of"].to_numpy(), rows["code"].to_numpy().view(np.uint64), rows["n"].to_numpy()
        for i in range(1, len(group) + 1):
            models.append(known.sparkSession.sparkContext.broadcast(KneserNey(code[of == i], n[of == i])))
    model = Model(languages, models, sum(size_of.values()) <= entries)

    some = known.select(F.xxhash64("text").alias("key"), F.length("text").alias("size")).distinct().orderBy("key", "size").limit(sample)
    chosen = known.join(F.broadcast(some.select("key")), F.xxhash64("text") == F.col("key"), "left_semi").dropDuplicates(["lang", "text"])
    seen = map_batches(chosen.select("lang", "text"), _entropies(model), "lang string, n long, entropy array<double>").filter("n > 0")
    rows = seen.orderBy("lang", "n", "entropy").limit(2 * sample).toArrow()
    if len(rows):
        entropy, size = np.array(rows["entropy"].to_pylist()), rows["n"].to_numpy()
        truth = np.searchsorted(languages, np.array(rows["lang"].to_pylist(), object))
        gap = (entropy - entropy.min(1, keepdims=True)) * size[:, None]

        def loss(t: float) -> float:
            p = np.exp(-np.minimum(gap * t, 500))
            return float(-np.log(p[np.arange(len(p)), truth] / p.sum(1) + 1e-12).sum())

        model.temperature = min((float(t) for t in np.geomspace(1e-3, 1, 25)), key=loss)
        for i in range(len(languages)):
            own = entropy[truth == i, i]
            if len(own) > 1:
                model.usual[i] = own.mean(), own.std()
            else:
                model.usual[i] = entropy.min(1).mean(), max(entropy.min(1).std(), 1.0)
    return model


def _judge(model: Model | None, kept: list[str], reject: float):
    def make(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in kept}
        if model is None:
            return out | {"lang_pred": [UNKNOWN] * batch.num_rows, "score": np.zeros(batch.num_rows)}
        best, score, n = model.judge(batch.column("text"))
        score = np.where(n > 0, score, 0.0)
        names = [model.languages[b] if k and s >= reject else UNKNOWN for b, s, k in zip(best, score, n, strict=True)]
        return out | {"lang_pred": names, "score": score}

    return make


def identify(docs: DataFrame, parts: int = 5, held: int = 0, entries: int = ENTRIES, reject: float = 0.0) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns with those names are replaced.

    Learns from ``text`` and ``lang`` of rows whose ``crc32(doc_id) mod parts`` is not ``held``.
    """
    scratch = workspace(docs.sparkSession, "language")
    known = docs.filter("text is not null and lang is not null").filter(fold("doc_id", parts) != held).select("lang", "text")
    model = learn(known, scratch, entries)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    read = docs.select(*[F.col(f"`{c}`") for c in kept])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    return map_batches(read, _judge(model, kept, reject), f"{ddl}, lang_pred string, score double")
