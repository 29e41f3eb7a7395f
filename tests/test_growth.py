"""Work that must not grow faster than its input: plans, folders and state that a refresh leaves."""

from __future__ import annotations

import pytest

from auriga.operators import changes
from auriga.plans.refresh import CASES, refresh_case
from auriga.sources import files
from auriga.sources.stored import replace_table
from auriga.streaming.first_rows import first_rows, refresh_first_rows

ASSETS = "id_ativo,tag,tipo,fabricante,modelo,site,criticidade,data_instalacao,potencia_kw\nA1,B-1,Bomba,F,M,Sul,Alta,2020-01-01,100\n"


def test_a_line_is_parsed_once_per_form(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v,w\n1,2,3\r\n \r\r\n")
    (tmp_path / "b.csv").write_text("﻿\r\n﻿w,id,novo\n6,4,9\n")
    found = files.scan_csv(spark, str(tmp_path), columns=["id", "v", "w"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 2
    rows = sorted((r.id, r.v, r.w, r._rescued_data) for r in found.collect())
    assert rows == [("1", "2", "3", None), ("4", None, "6", '{"novo":"9"}')]


def test_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id,v\n1,2\n")
    plans, store = [], files.store_once

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(files, "store_once", recorded)
    assert files.scan_csv(spark, str(tmp_path)).count() == 1
    assert plans and not any("Sort" in plan for plan in plans)


def test_only_what_is_wanted_is_refreshed(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "ativos.csv").write_text(ASSETS)
    found = refresh_case(spark, "manutencao", str(raw), str(tmp_path / "lake"), wanted=["silver_ativos"])
    assert found["silver_ativos"].first().tag == "B-1"
    assert sorted(p.name for p in (tmp_path / "lake").iterdir()) == ["bronze_ativos", "rescued_ativos", "silver_ativos"]


@pytest.mark.parametrize("case", CASES)
def test_reads_are_those_of_the_plans(case):
    layers = CASES[case]
    plans = {f"silver_{n}": plan for n, (_, plan) in layers.silver.items()} | {f"gold_{n}": plan for n, plan in layers.gold.items()}
    for name, plan in plans.items():
        named = {x for x in plan.__code__.co_consts if isinstance(x, str) and x.startswith(("bronze_", "silver_", "gold_"))}
        assert named == set(layers.reads.get(name, [])), name
    assert layers.needed(layers.tables()) == set(layers.tables())


def test_first_rows_hold_no_state(spark, tmp_path):
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    for rows in ([(1, 5, 2, "a"), (2, 1, 1, "b")], [(1, 5, 1, "late"), (2, 1, 1, "c"), (3, None, 0, None)]):
        spark.createDataFrame(rows, "k int, o int, a int, v string").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("k int, o int, a int, v string").parquet(folder)
        refresh_first_rows(stream, ["k"], ["o", "a", "v"], table, check)
    assert sorted(map(tuple, first_rows(spark, ["k"], table).collect())) == [(1, 5, 1, "late"), (2, 1, 1, "b"), (3, None, 0, None)]
    assert not (tmp_path / "check" / "state").exists()


def test_a_first_sync_copies_the_table(spark, tmp_path, monkeypatch):
    path, copy = str(tmp_path / "t"), str(tmp_path / "c")
    replace_table(spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int"), path)

    def no_feed(*_):
        raise AssertionError("a first sync needs no feed")

    monkeypatch.setattr(changes, "store_once", no_feed)
    assert sorted(map(tuple, changes.sync(spark, path, copy, ["k"]).collect()), key=str) == [("a", 1), ("a", 1), (None, 2)]
    assert changes.offset_of(spark, copy) == 1
