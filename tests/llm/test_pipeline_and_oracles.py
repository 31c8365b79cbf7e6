from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"


def _entry():
    import __spark_entry__

    return __spark_entry__


@pytest.mark.parametrize("name", ["op4_secret_scan", "op6_quality_rules", "op7_superminhash", "op8_spherical_caps", "op9_host_reputation", "op12_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    entry = _entry()
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    as_rows = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert as_rows(got) == as_rows(want)


def test_every_operator_is_registered():
    names = list(_entry().queries())
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names


def test_pipeline(spark, prose, tmp_path):
    """Each stage against what it must do to planted cases; all rows of a stage reach the next."""
    import corpus_pipeline as cp

    rng = random.Random(1)
    clean = [(i, prose(150 + i, 300 + i), "en", "abc"[i % 3], 1) for i in range(30)]
    copies = [(100, clean[0][1], "en", "a", 1), (101, clean[1][1] + " end.", "en", "b", 1), (0, clean[0][1], "en", "a", 1)]
    junk = [(200, "Home | News | Shop\n" * 40, "en", "a", 1), (201, "too short.", "en", "a", 1), (202, None, None, None, None), (203, "", "en", None, 0)]
    secret = (300, prose(150, 900) + "\nThe password = hunter2hunter2 is kept here.", "en", "c", 1)
    rows = [*clean, *copies, *junk, secret, (None, prose(100, 901), "en", None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    root = tmp_path / "sf"
    docs.write.parquet(str(root / "documents.parquet"))
    seen = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(root))
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.schema == docs.schema
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    ids = lambda name: sorted((r.doc_id for r in seen[name]), key=str)
    assert ids("quality_rules") == sorted([*range(30), 0, 100, 101, 300, None], key=str)
    assert ids("near_duplicates") == sorted([*range(30), 300, None], key=str) == ids("secrets")
    assert all(r.n_chars == len(r.text) for r in seen["quality_rules"])
    assert [r for r in seen["secrets"] if r.doc_id == 300][0].text.endswith("The [SECRET] is kept here.")
    by_id = {r.doc_id: r.text for r in seen["near_duplicates"] if r.doc_id not in (300,)}
    assert all(by_id[r.doc_id] == r.text for r in seen["secrets"] if r.doc_id != 300)
    assert set(ids("source_mixing")) <= set(ids("secrets")) and max(map(ids("source_mixing").count, set(ids("source_mixing")))) <= 2
    assert sorted(map(str, {r.doc_id for r in seen["best_fit_packing"]})) == sorted(map(str, set(ids("source_mixing"))))
    assert sum(r.piece == 0 for r in seen["best_fit_packing"]) == len(seen["source_mixing"])
    by = {}
    for r in seen["best_fit_packing"]:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096
    again = cp.run(spark, str(root))
    assert again.count() == len(seen["best_fit_packing"])


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    import corpus_pipeline as cp

    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []
