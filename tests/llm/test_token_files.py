"""Exact round trips of the coder and of the files, and what damage does to them."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinfold.llm.common import workspace
from kinfold.llm.mixcoder import _Model, decode, encode
from kinfold.llm.packing import tokenizer
from kinfold.llm.queries import vocabulary
from kinfold.llm.tokenfiles import frames, read_tokens, token_files, write_tokens

from .conftest import ROWS, SF_DIR


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 2**20 - 1)), max_size=300), st.integers(1, 40), st.integers(1, 7), st.sampled_from([20, 24]))
def test_round_trip(ids, block, lanes, bits):
    frame = encode(np.array(ids, np.uint32), bits, block, lanes)
    assert decode(frame, lanes=lanes).tolist() == ids
    assert decode(frame, 1, 2, lanes).tolist() == ids[block : 3 * block]


@pytest.mark.parametrize("kind", ["constant", "cycle", "random", "extremes"])
def test_round_trip_of_long_streams(kind):
    n = 70_000
    ids = {
        "constant": np.full(n, 50256),
        "cycle": np.arange(n) % 17 * 3001,
        "random": np.random.default_rng(1).integers(0, 1 << 16, n),
        "extremes": np.random.default_rng(2).choice([0, (1 << 16) - 1], n),
    }[kind].astype(np.uint32)
    frame = encode(ids, 16)
    assert (decode(frame) == ids).all()
    assert len(frame) / n < {"constant": 0.1, "cycle": 0.3, "random": 2.2, "extremes": 0.6}[kind]


def test_prediction_makes_text_smaller():
    loaded = Tokenizer.from_file(vocabulary())
    ids = [x for (t,) in duckdb.sql(f"select text from '{SF_DIR}/documents.parquet' order by doc_id limit 100").fetchall() for x in loaded.encode(t).ids]
    assert len(encode(np.array(ids, np.uint32), 16)) < 0.75 * 2 * len(ids)


def test_both_orders_read_one_line_of_cache():
    model = _Model(50)
    model.one[:], model.two[:] = np.random.default_rng(5).integers(0, 1 << 16, (2, 50))
    model.predict(50)
    lines = [(model.slots.ctypes.data + 4 * at) // 64 for at in model.at]
    assert (lines[0] == lines[1]).all() and len(set(lines[0].tolist())) == 50
    assert (model.at[0] != model.at[1]).all()


@settings(deadline=None)
@given(st.lists(st.sampled_from(["a", "Ab", "é", "ß", "'s", "'t", "'", "12", "!", "...", " ", " ", "  ", "\n", " \n", "\n ", "\t", "\r\n"]), max_size=12).map("".join))
def test_texts_without_neighbouring_spaces_split_alike(text):
    own = tokenizer(vocabulary())
    assert own.encode(text) == own.fast.encode_ordinary(text) == own.loaded.encode(text, add_special_tokens=False).ids
    assert own.apart.encode_ordinary("it's 12 a b.\nEnd ") == own.fast.encode_ordinary("it's 12 a b.\nEnd ")


def test_damage_is_found():
    frame = bytearray(encode(np.arange(9000, dtype=np.uint32) % 700, 16))
    for at in (0, 9, 30, len(frame) - 40, len(frame) // 2):
        frame[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            decode(bytes(frame))
        frame[at] ^= 1
    with pytest.raises(ValueError, match="bits"):
        encode(np.zeros(3), 25)


def plain(rows):
    """Documents in order of their ids (unique here, but for a null), by the library."""
    loaded, start, out = Tokenizer.from_file(vocabulary()), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*(loaded.encode(t, add_special_tokens=False).ids if t else ()), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files(spark, docs, empty, tmp_path):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet' order by doc_id limit 100").fetchall()
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x"))
    want = plain(rows)
    assert [tuple(r) for r in token_files(frame.repartition(5), vocabulary()).orderBy("doc_id").collect()] == [w[:4] for w in want]
    # Several parts, and several frames in each of them.
    folder = str(tmp_path / "files")
    write_tokens(frame, vocabulary(), folder, frame_ids=30_000)
    assert frames(spark, folder).count() > 2
    found = read_tokens(spark, folder, workspace(spark, "test")).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == want


def test_odd_rows(spark, docs, empty):
    found = [tuple(r) for r in token_files(docs, vocabulary()).orderBy("start").collect()]
    want = plain([(r[0], r[1]) for r in ROWS])
    assert found == [w[:4] for w in want]
    assert token_files(empty, vocabulary()).count() == 0


def test_rows_of_one_id_spread_over_ranges(spark, monkeypatch):
    import kinfold.llm.tokenfiles as files

    monkeypatch.setattr(files, "RANGE_BYTES", 500)
    rows = [(None, "same text")] * 300 + [(4, f"text {i}") for i in range(200)] + [(9, "end")]
    found = token_files(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary()).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [r[0] for r in rows]
    assert [r["start"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found])[:-1].tolist()
    assert sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in found) == sorted((w[0] or 0, w[3]) for w in plain(rows))
