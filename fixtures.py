"""Person records derived from the `customer` table, for queries and tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.skew import spread

# Syllables of the invented names, all different in their first two letters.
SYLLABLES = (
    "ba,ren,lo,mi,ka,tor,vel,sa,du,gri,no,pel,wy,fen,hal,zu,ar,el,is,on,ul,be,co,da,fa,ge,hi,je,ko,le,ma,"
    "ni,ol,pa,qui,ro,se,ta,ur,va,wi,xe,ya,ze,bri,cle,dro,flo"
)


def _syllable(index: str) -> str:
    return f"split_part('{SYLLABLES}', ',', cast({index} as int) + 1)"


def _name(h: str) -> str:
    return f"concat({_syllable(f'({h}) % 48')}, {_syllable(f'floor(({h}) / 48) % 48')}, {_syllable(f'floor(({h}) / 7) % 48')})"


def person_columns() -> dict[str, str]:
    """Record columns over customer number k, nation nk, copy number v and true names f and l, as SQL."""
    mail = "concat(f, '.', l, '@example.com')"
    return {
        "record_id": "concat('r', lpad(cast(k * 4 + v as varchar(20)), 8, '0'))",
        "first_name": "case when v = 2 then concat(substr(f, 1, 3), substr(f, 5, 1), substr(f, 4, 1), substr(f, 6))"
        " else f end",
        "last_name": "case when v = 1 and k % 2 = 0 then concat(substr(l, 1, 3), substr(l, 5)) else l end",
        "email": f"case when v = 1 then upper({mail}) when v = 2 and k % 2 = 0"
        f" then concat(substr(f, 2), '.', l, '@example.com') else {mail} end",
        "postcode": "concat('P', lpad(cast((k * 31) % 9973 as varchar(20)), 4, '0'),"
        " case when v = 2 and k % 4 = 0 then 'X' else 'A' end)",
        "city": "case when v = 1 and k % 5 = 0 then '' else concat('City', cast(nk % 15 as varchar(20))) end",
        "truth": "concat('c', cast(k as varchar(20)))",
    }


NAMES = {"f": _name("(k * 7919) % 4093"), "l": _name("(k * 2621 + 13) % 4091")}


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    copies = F.expr("filter(array(0, 1, 2), v -> v = 0 or (v = 1 and k % 3 = 0) or (v = 2 and k % 9 = 0))")
    base = customer.selectExpr("c_custkey as k", "c_nationkey as nk")
    base = spread(base, customer.count(), "k")  # before the wide columns are made: the file may be a single task
    return base.select("k", "nk", F.explode(copies).alias("v"))


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer once, every third twice and every ninth three times, the copies damaged."""
    named = _copies(spark, sf_dir).selectExpr("k", "nk", "v", *[f"{e} as {n}" for n, e in NAMES.items()])
    return named.selectExpr(*[f"{e} as {n}" for n, e in person_columns().items()])


# Which damage `person_columns` does to copy v of customer k.
VARIATIONS = {
    "email_case": "v = 1",
    "email_typo": "v = 2 and k % 2 = 0",
    "given_name_typo": "v = 2",
    "surname_typo": "v = 1 and k % 2 = 0",
    "postcode_typo": "v = 2 and k % 4 = 0",
    "missing_city": "v = 1 and k % 5 = 0",
}


def variations_sql(array: Callable[..., str]) -> str:
    return array(*[f"case when {test} then '{name}' end" for name, test in VARIATIONS.items()])


def damaged_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies with the list of their ``variations``."""
    listed = variations_sql(lambda *entries: f"array_compact(array({', '.join(entries)}))")
    return _copies(spark, sf_dir).selectExpr("k", "v", f"{listed} as variations")


def persons_sql() -> str:
    """The same rows as a DuckDB common table expression named ``persons``."""
    names = ", ".join(f"{e} as {n}" for n, e in NAMES.items())
    columns = ", ".join(f"{e} as {n}" for n, e in person_columns().items())
    return (
        "base as (select c_custkey as k, c_nationkey as nk, v from customer cross join (values (0), (1), (2)) t(v)"
        " where v = 0 or (v = 1 and c_custkey % 3 = 0) or (v = 2 and c_custkey % 9 = 0)),"
        f" named as (select k, nk, v, {names} from base), persons as (select {columns} from named)"
    )
