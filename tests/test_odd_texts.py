"""Queries against their SQL on documents that the generated tables lack: white space at the ends, blank, null and odd texts."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quern import catalog
from quern.operators import models

TEXTS = ["  lead", "trail \n", "\n a\nb \t", "", " ", None, "　wide　", " x\u0085", "a\r\nb", "the  cat\tsat", "\U0001f600 two", "thi\u017f Big table runs", "\u0130N the der", "a|b 1,2. ... x2 Grande fast. the, quickly"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    d, n = tmp_path_factory.mktemp("odd"), len(TEXTS)
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(TEXTS, pa.string()), "lang": ["en", "de"] * (n // 2) + ["en"] * (n % 2), "source": ["s"] * n, "n_chars": pa.array([len(t or "") for t in TEXTS], pa.int64())}), d / "documents.parquet")
    return str(d)


def equal(spark, name, d, tables=("documents",)):
    shown = lambda x: "null" if x is None else f"{x:.6g}" if isinstance(x, float) else str(x)
    df = catalog.QUERIES[name](spark, d)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    rows = con.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({catalog.ORACLES[name]}) r").fetchall()
    assert sorted(tuple(map(shown, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(shown, r)) for r in rows)


@pytest.mark.parametrize("name", ["language_adapter", "one_line_captions"])
def test_ends_stay_where_sql_keeps_them(spark, odd, name):
    equal(spark, name, odd)


@pytest.mark.parametrize("name", ["descriptive_filter", "pos_pattern_filter", "pos_signature", "pos_counts", "pattern_mining", "language_struct", "confident_caption_filter", "caption_length_filter"])
def test_stand_ins_read_odd_texts_as_sql_does(spark, odd, name):
    equal(spark, name, odd)


@pytest.mark.parametrize(("name", "runs"), [("descriptive_filter", 1), ("pos_pattern_filter", 2), ("pos_signature", 1), ("confident_caption_filter", 1)])
def test_each_caption_is_judged_once(spark, odd, name, runs):
    """In one Python pass, and not in lambdas over its words."""
    plan = catalog.QUERIES[name](spark, odd)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == runs
    assert "rlike" not in plan.lower() and "try_element_at" not in plan and "split(" not in plan.split("ArrowEvalPython")[-1]


def test_tags_by_lookup_are_those_of_the_rules():
    ends = ["", ".", ",", ",.", "..", "-"]
    words = {a + b + c for a in ["", "x", "X", "\u00e9", "\u0130", "1", "#", "."] for b in ["", *models._LISTED, *models._ENDINGS, "thi\u017f", "THE", "ING", "2,3"] for c in ends} - {""}
    for w in words:
        assert models.tag_number(w) == next(i for i, rule in enumerate(models._PYTHON_RULES) if rule.search(w)), w


def test_numbering_for_metrics_moves_no_text(spark, odd, monkeypatch):
    from quern.operators import explore

    seen, real = [], explore.stored
    monkeypatch.setattr(explore, "stored", lambda df, name: seen.append(df.columns) or real(df, name))
    equal(spark, "batch_metrics", odd)
    assert seen and not any("txt" in c for c in seen)


def test_shards_are_cut_at_keys_without_sorting_samples(spark, monkeypatch, tmp_path):
    from quern.operators import explore
    from quern.sinks import files
    from quern.sources import shards

    seen, real = [], explore.stored
    monkeypatch.setattr(explore, "stored", lambda df, name: seen.append(df.columns) or real(df, name))
    rows = [("s", f"{i:03d}", f"{i:032x}", f"t{i}", b"j", f'{{"uid": "{i:032x}"}}') for i in range(25)]
    df = spark.createDataFrame(rows, "shard string, key string, uid string, txt string, jpg binary, meta string").repartition(3)
    out = str(tmp_path / "a")
    assert sorted(map(tuple, files.write_shards(df, out, 10).collect())) == [("00000000.tar", 10), ("00000001.tar", 10), ("00000002.tar", 5)]
    assert not any("txt" in c for c in seen)
    got = shards.read_shards(spark, out).orderBy("key").collect()
    assert [(r["key"], r["txt"], r["shard"]) for r in got] == [(f"{i:03d}", f"t{i}", f"{i // 10:08d}.tar") for i in range(25)]
    again = df.union(df.where("key = '009'"))  # its copies are samples 9 and 10
    assert sorted(map(tuple, files.write_shards(again, str(tmp_path / "b"), 10).collect())) == [("00000000.tar", 10), ("00000001.tar", 10), ("00000002.tar", 6)]
    assert files.write_shards(df.where("false"), str(tmp_path / "c"), 10).collect() == []
    assert [p.rpartition("/")[2] for p in shards.leading(spark, out, 11)] == ["00000000.tar", "00000001.tar"]
    plan = shards.read_shards(spark, out, uids=df.select("uid").limit(3))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("MapInArrow")[0]  # captions are not joined


def test_stream_takes_small_files_together(spark, monkeypatch, tmp_path):
    from quern.sinks import files
    from quern.streaming.shards import filtered_to, shard_stream
    from quern.plans.steps import FilterStep

    df = spark.createDataFrame([("s", f"{i:03d}", f"{i:032x}", "t", b"j", f'{{"uid": "{i:032x}"}}') for i in range(20)], "shard string, key string, uid string, txt string, jpg binary, meta string")
    files.write_shards(df, str(tmp_path / "in"), 2).collect()
    q = filtered_to(shard_stream(spark, str(tmp_path / "in")), FilterStep("t"), str(tmp_path / "o"), str(tmp_path / "c"))
    q.awaitTermination()
    assert spark.read.schema("uid string").parquet(str(tmp_path / "o")).count() == 20
    assert q.lastProgress["batchId"] == 0
