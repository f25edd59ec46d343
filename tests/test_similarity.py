from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.functions import similarity
from kinfold.functions.similarity import bound_helpers, jaro_winkler_arrow, may_reach
from kinfold.operators.comparison import COMPARISONS, compare_pairs, with_helpers


def _plain_jaro(a: str, b: str) -> float:
    reach, free, taken = max(max(len(a), len(b)) // 2 - 1, 0), [True] * len(a), []
    for j, char in enumerate(b):
        for i in range(max(j - reach, 0), min(j + reach + 1, len(a))):
            if free[i] and a[i] == char:
                free[i] = False
                taken.append(char)
                break
    m = len(taken)
    swapped = sum(x != y for x, y in zip((c for c, f in zip(a, free, strict=True) if not f), taken, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3 if m else 0.0


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij", "abcé日 "])
def test_long_texts_equal_the_plain_form(alphabet):
    rng = random.Random(len(alphabet))
    left, right = [], []
    for size in (64, 65, 66, 127, 128, 129, 200, 256, 257, 400, 512):
        for _ in range(4):
            a = [rng.choice(alphabet) for _ in range(size)]
            b = [c for c in a if rng.random() > 0.1] + [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
            left.append("".join(a))
            right.append("".join(rng.sample(b, len(b))) if rng.random() < 0.3 else "".join(b))
    found = jaro_winkler_arrow(pa.array(left), pa.array(right)).to_pylist()
    for a, b, got in zip(left, right, found, strict=True):
        jaro = _plain_jaro(a, b)
        prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(b)))
        assert got == pytest.approx(jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro, abs=1e-11)


def _texts(seed: int, count: int) -> tuple[list[str], list[str]]:
    rng = random.Random(seed)
    left, right = [], []
    for _ in range(count):
        alphabet = rng.choice(("ab", "abcd", "abcdefghij", "abcdefghijklmno.@"))
        size = rng.choice((3, 8, 20, 45, 70, 130))
        a = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, size)))
        b = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, size)))
        if rng.random() < 0.5:
            cut = rng.randint(0, len(a))
            b = a[:cut] + rng.choice(alphabet) + a[cut + 1 :]
        left.append(a)
        right.append(b)
    return left, right


def test_equals_duckdb_on_ascii():
    left, right = _texts(3, 20_000)
    pairs = pa.table({"l": left, "r": right})  # noqa: F841 - read by name below
    want = duckdb.sql("select jaro_winkler_similarity(l, r) as s from pairs").to_arrow_table()["s"].to_numpy()
    got = jaro_winkler_arrow(pa.array(left), pa.array(right)).to_numpy()
    assert np.abs(got - want).max() < 1e-11


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("MARTHA", "MARHTA", 0.961111111111),
        ("DWAYNE", "DUANE", 0.84),
        ("", "a", 0.0),
        ("", "", 0.0),
        ("é", "é", 1.0),
        ("日本", "本日", 0.0),
        ("a", "aÿ", 0.85),
        ("a" * 100, "a" * 100, 1.0),
    ],
)
def test_known_values(a, b, score):
    assert jaro_winkler_arrow(pa.array([a]), pa.array([b])).to_pylist() == [pytest.approx(score)]


def test_null_stays_null_and_slices_work():
    left = pa.array(["x", None, "abc", "abd"])[1:]
    right = pa.array(["y", "a", "abc", None])[1:]
    assert jaro_winkler_arrow(left, right).to_pylist() == [None, 1.0, None]


@pytest.mark.parametrize("threshold", [0.7, 0.88, 0.92])
def test_bound_never_rules_out_a_reachable_pair(spark, threshold):
    left, right = _texts(11, 4_000)
    left += ["日本語", "ﬀab"]
    right += ["日本誤", "ab"]
    score = jaro_winkler_arrow(pa.array(left), pa.array(right)).to_pylist()
    df = spark.createDataFrame(list(zip(left, right, score, strict=True)), "t_l string, t_r string, s double")
    helpers = [f"{sql} as {name}_{s}" for s in "lr" for name, sql in bound_helpers("t", f"t_{s}").items()]
    tested = df.selectExpr("*", *helpers).select("s", F.expr(may_reach("t", threshold)).alias("open"))
    assert tested.filter(f"s >= {threshold} and not open").count() == 0
    assert tested.filter("not open").count() > 0


@pytest.mark.parametrize("least", [0.7, 0.88, 0.92])
def test_values_from_a_least_one_are_exact(least):
    left, right = (pa.array(x) for x in _texts(17, 6_000))
    exact = jaro_winkler_arrow(left, right).to_numpy()
    found = jaro_winkler_arrow(left, right, least).to_numpy()
    assert (found[exact >= least] == exact[exact >= least]).all()
    assert (found[exact < least] < least).all()
    assert (found[exact < least] == 0).any()


def test_equal_pairs_of_a_batch_are_compared_once(monkeypatch):
    compared, plain = [], similarity._jaro_short
    monkeypatch.setattr(similarity, "_jaro_short", lambda *given: compared.append(len(given[2])) or plain(*given))
    left, right = ["martha", "dwayne", None, "martha"] * 500, ["marhta", "duane", "x", "duane"] * 500
    found = jaro_winkler_arrow(pa.array(left), pa.array(right)).to_pylist()
    assert found[:2] == [pytest.approx(0.961111111111), pytest.approx(0.84)] and found == found[:4] * 500
    assert sum(compared) == 3


def _gammas(spark, left: dict, right: dict) -> dict[str, int]:
    schema = "first_name string, last_name string, email string, postcode string, city string"
    fields = ("first_name", "last_name", "email", "postcode", "city")
    sides = []
    for values, s in ((left, "l"), (right, "r")):
        df = with_helpers(spark.createDataFrame([tuple(values.get(f) for f in fields)], schema))
        sides.append(df.withColumnsRenamed({c: f"{c}_{s}" for c in df.columns}).withColumn("k", F.lit(1)))
    row = compare_pairs(sides[0].join(sides[1], "k")).first()
    return {c.column: row[f"gamma_{c.column}"] for c in COMPARISONS}


def test_levels(spark):
    got = _gammas(
        spark,
        dict(first_name="martha", last_name="smith", email="ann.lee@example.com", postcode="AB12 3CD", city="X"),
        dict(first_name="marhta", last_name="jones", email="ann.lee@example.org", postcode="AB12 3CE", city="Y"),
    )
    assert got == {"first_name": 3, "last_name": 0, "email": 3, "postcode": 2, "city": 0}
    got = _gammas(
        spark,
        dict(first_name="x", email="annlee1@a.com", postcode="AB1", city="X"),
        dict(first_name="x", last_name="y", email="annlee2@zzzzzzzzzzzzzzzz.net", postcode="CB2", city="X"),
    )
    assert got == {"first_name": 4, "last_name": -1, "email": 1, "postcode": 1, "city": 1}
    got = _gammas(spark, dict(email="@a.com", postcode="AB1"), dict(email="@b.org", postcode="XY9Z"))
    assert got["email"] in (0, 2) and got["postcode"] == 0 and got["city"] == -1
