"""Files to tables: incremental reads, full refresh, rescued text, whole case refresh."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.operators.changes import changes_between, sync
from auriga.operators.maintenance import daily_telemetry
from auriga.plans.refresh import refresh_case
from auriga.sources import files, stored
from auriga.sources.stored import read_table, replace_table
from auriga.streaming.first_rows import first_rows, refresh_first_rows
from auriga.streaming.tables import StreamTable
from auriga.streaming.telemetry import daily_from_moments, moments, refresh_daily_telemetry


def test_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in (1, 2):
        (raw / f"leituras_lote0{i}.csv").write_text(f"id,v\n{i},1.5\n")
    (raw / "outros.csv").write_text("a,b\n1,2\n")

    def load():
        table = StreamTable(spark, str(tmp_path / "t"), "bronze_leituras")
        return table.refresh(files.stream_csv(spark, str(raw), "leituras_lote*.csv")).read().count()

    assert load() == 2
    (raw / "leituras_lote03.csv").write_text("id,v\n3,1.5\n")
    assert load() == 3
    assert load() == 3


def test_full_refresh_starts_a_new_version(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a1.csv").write_text("id\n1\n")
    table = StreamTable(spark, str(tmp_path / "t"), "x")
    stream = lambda: files.stream_csv(spark, str(raw))
    assert (table.refresh(stream()).read().count(), table.version) == (1, 1)
    (raw / "a2.csv").write_text("id\n2\n")
    assert (table.refresh(stream(), full=True).read().count(), table.version) == (2, 2)
    assert StreamTable(spark, str(tmp_path / "t"), "x").version == 2


def test_misshapen_lines_are_rescued(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,2\n3,4,5\n6\n"7","a ""b"" c"\n')
    rows = {r.id: (r.v, r._rescued_data) for r in files.scan_csv(spark, str(tmp_path)).collect()}
    assert rows["1"] == ("2", None)
    assert rows["3"] == ("4", "3,4,5")
    assert rows["6"][1] == "6"
    assert rows["7"] == ('a "b" c', None)


@pytest.mark.parametrize("streamed", [False, True])
def test_columns_are_placed_by_name(spark, tmp_path, streamed):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("id,v\n1,10\n")
    (raw / "b.csv").write_text('v,id,novo\n20,2,"x, y"\n')
    (raw / "c.csv").write_text("id\n3\n")
    (raw / "d.csv").write_text("")

    def read(columns=None):
        if not streamed:
            return files.scan_csv(spark, str(raw), "*.csv", columns)
        table = StreamTable(spark, str(tmp_path / f"t{len(columns or ())}"), "x")
        return table.refresh(files.stream_csv(spark, str(raw), "*.csv", columns)).read()

    got = sorted((r.id, r.v, r._rescued_data) for r in read(["id", "v"]).collect())
    assert got == [("1", "10", None), ("2", "20", '{"novo":"x, y"}'), ("3", None, None)]
    assert sorted((r.id, r.v, r.novo) for r in read().collect()) == [("1", "10", None), ("2", "20", "x, y"), ("3", None, None)]


@pytest.mark.parametrize("streamed", [False, True])
def test_paths_headers_and_blank_lines(spark, tmp_path, streamed):
    raw = tmp_path / "dados brutos ção 100%"
    raw.mkdir()
    (raw / "a b.csv").write_text("id,v\n1,x\n\nid,v\n2,y\n")
    (raw / "ç%20.csv").write_text("\ufeffv,id\r\nz,3\r\n")
    (raw / "one.csv").write_text("\nid\n4\n\n")

    def read():
        if not streamed:
            return files.scan_csv(spark, str(raw))
        return StreamTable(spark, str(tmp_path / "t"), "x").refresh(files.stream_csv(spark, str(raw))).read()

    got = sorted(((r.id, r.v, r._rescued_data) for r in read().collect()), key=str)
    assert got == sorted(
        [("1", "x", None), ("id", "v", None), ("2", "y", None), ("3", "z", None), ("4", None, None), (None, None, None)], key=str
    )


def test_a_refresh_opens_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(30):
        (raw / f"f{i}.csv").write_text(f"id\n{i}\n")
    table = StreamTable(spark, str(tmp_path / "t"), "x")
    table.refresh(files.stream_csv(spark, str(raw)))
    # Old files that can no longer be read as they were don't matter to a refresh.
    for i in range(30):
        (raw / f"f{i}.csv").write_bytes(b"")
    (raw / "new.csv").write_text("id,more\n99,m\n")
    seen = []

    class Counting(files.CsvStream):
        def parse(self, batch, known):
            seen.extend(r[0] for r in batch.select("_file").distinct().collect())
            return super().parse(batch, known)

    table.refresh(Counting(files.stream_csv(spark, str(raw)).lines))
    assert [p.rsplit("/", 1)[1] for p in seen] == ["new.csv"]
    got = {(r.id, r._rescued_data) for r in table.read().collect()}
    assert len(got) == 31 and ("99", '{"more":"m"}') in got


def test_a_batch_that_runs_again_gives_the_same_table(spark, tmp_path):
    table = StreamTable(spark, str(tmp_path / "t"), "x")
    table._next_version()
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("id\n1\n2\n")
    append = table._appending(files.stream_csv(spark, str(tmp_path / "raw")))
    batch = files._lines(spark.read, str(tmp_path / "raw"), "*.csv")
    for _ in range(2):
        append(batch, 0)
    assert sorted(r.id for r in table.read().collect()) == ["1", "2"]


def test_cast_or_rescue(spark):
    raw = spark.createDataFrame([("1", "x", " "), ("2", "2024-02-30", "5"), ("3", "2024-02-29", None)], "k string, d string, n string")
    got = {r.k: (str(r.d), r.n, r._rescued_data) for r in files.cast_or_rescue(raw, {"k": "int", "d": "date", "n": "int"}).collect()}
    assert got == {1: ("None", None, '{"d":"x"}'), 2: ("None", 5, '{"d":"2024-02-30"}'), 3: ("2024-02-29", None, None)}
    scanned = spark.createDataFrame([("1", "3,4,5"), ("x", "6"), ("2", None)], "k string, _rescued_data string")
    kept = [r._rescued_data for r in files.cast_or_rescue(scanned, {"k": "int"}).collect()]
    assert kept == ["3,4,5", '{"k":"x","_rescued_data":"6"}', None]


def test_whole_texts_and_binary(spark, tmp_path):
    (tmp_path / "p1.md").write_text("# A\n\n## B\n")
    (tmp_path / "p2.txt").write_text("skip")
    assert [tuple(r) for r in files.whole_texts(spark, str(tmp_path), "*.md").collect()] == [("p1.md", "# A\n\n## B\n")]
    row = files.binary_files(spark, str(tmp_path), "*.md").first()
    assert (row.arquivo, row.length, bytes(row.content)) == ("p1.md", 10, b"# A\n\n## B\n")


def test_replace_table_is_idempotent(spark, tmp_path):
    df = spark.range(3)
    replace_table(df, str(tmp_path / "x"))
    assert replace_table(df, str(tmp_path / "x")).count() == 3


RAW = {
    "ativos.csv": "id_ativo,tag,tipo,fabricante,modelo,site,criticidade,data_instalacao,potencia_kw\n"
                  "A1,B-1,Bomba,F,M,Sul,Alta,2020-01-01,100\nA2,B-2,Motor,F,M,Sul,Baixa,2020-01-01,100\n",
    "falhas.csv": "id_falha,id_ativo,data_falha,causa,componente,severidade\nF1,A1,2024-01-05,c,p,Alta\nF2,A1,2024-01-15,c,p,Alta\n",
    "ordens_manutencao.csv": "id_ordem,id_ativo,tipo,data_abertura,data_fechamento,custo,downtime_horas,descricao\n"
                             "O1,A1,Corretiva,2024-01-05,2024-01-06,100.50,3.5,x\n",
    "leituras_sensores_lote01.csv": "id_leitura,id_ativo,data_hora,temperatura,vibracao,pressao,rpm\n"
                                    "1,A1,2024-01-01 10:00:00,50,1,2,900\n2,A2,2024-01-01 10:00:00,50,1,2,900\n",
}


def test_case_refresh_grows_with_a_new_lot(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    for name, text in RAW.items():
        (raw / name).write_text(text)
    first = refresh_case(spark, "manutencao", str(raw), root)
    assert first["bronze_leituras_sensores"].count() == 2
    (raw / "leituras_sensores_lote02.csv").write_text(
        RAW["leituras_sensores_lote01.csv"].splitlines()[0] + "\n3,A1,2024-01-20 10:00:00,50,3,2,900\n"
    )
    second = refresh_case(spark, "manutencao", str(raw), root)
    assert second["silver_leituras"].count() == 3
    risk = {r.id_ativo: (r.score_risco, r.n_falhas, r.mtbf_dias) for r in second["gold_ativos_risco"].collect()}
    assert risk == {"A1": (43, 2, 10.0)}
    again = refresh_case(spark, "manutencao", str(raw), root, full=True)
    assert again["silver_leituras"].count() == 3


def test_late_and_newest_days_are_in_the_daily_table(spark, tmp_path):
    fields = "id_leitura bigint, id_ativo string, tag string, tipo string, site string, criticidade string, data_hora timestamp, temperatura double, vibracao double, pressao double, rpm int"
    folder = str(tmp_path / "in")

    def deliver(*days):
        rows = [(d, "A", "t", "Bomba", "Sul", "Alta", datetime(2024, 1, d, 9), 50.0, float(d), 1.0, 900) for d in days]
        spark.createDataFrame(rows, fields).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(fields).parquet(folder)
        refresh_daily_telemetry(stream, str(tmp_path / "daily"), str(tmp_path / "check"))
        return sorted(r.dia.day for r in spark.read.parquet(str(tmp_path / "daily")).collect())

    assert deliver(5, 6) == [5, 6]
    assert deliver(2, 6, 9) == [2, 5, 6, 9]
    daily = spark.read.parquet(str(tmp_path / "daily")).filter("dia = '2024-01-06'").first()
    assert daily.n_leituras == 2
    # Readings of former batches are not read again.
    for old in (tmp_path / "in").glob("part-*"):
        old.write_bytes(b"")
    assert deliver(10) == [2, 5, 6, 9, 10]


def test_moments_merge_to_the_daily_table(spark):
    rng = np.random.default_rng(4)
    rows = [
        (int(i), f"A{i % 3}", "t", "Bomba", "Sul", "Alta", datetime(2024, 1, 1 + i % 2, 9),
         None if i % 11 == 0 else float(rng.normal(50, 9)), None if i % 7 == 0 or i % 3 == 2 else float(rng.normal(1e4, 3)), 1.0, 900 + i)
        for i in range(400)
    ]
    fields = "id_leitura bigint, id_ativo string, tag string, tipo string, site string, criticidade string, data_hora timestamp, temperatura double, vibracao double, pressao double, rpm int"
    readings = spark.createDataFrame([*rows, (999, "A9", *rows[0][2:6], datetime(2024, 1, 9), None, 1.5, None, None)], fields)
    parts = [moments(readings.filter(f"id_leitura % 5 = {n}")) for n in range(5)]
    merged = daily_from_moments(reduce(DataFrame.unionAll, parts))
    whole = daily_telemetry(readings)
    assert merged.columns == whole.columns
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_first_rows_take_late_ones(spark, tmp_path):
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))

    def deliver(*rows):
        spark.createDataFrame(rows, "k int, o int, v string").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("k int, o int, v string").parquet(folder)
        refresh_first_rows(stream, ["k"], ["o", "v"], table, check)
        return {r.k: (r.o, r.v) for r in first_rows(spark, ["k"], table).collect()}

    assert deliver((1, 5, "a"), (1, 5, "b"), (2, 1, "c"), (None, 3, "n")) == {1: (5, "a"), 2: (1, "c"), None: (3, "n")}
    assert deliver((1, 9, "z"), (2, 1, "c"), (3, 0, None)) == {1: (5, "a"), 2: (1, "c"), 3: (0, None), None: (3, "n")}
    assert deliver((1, 4, "late"), (None, 2, "m")) == {1: (4, "late"), 2: (1, "c"), 3: (0, None), None: (2, "m")}


def test_a_lost_replacement_leaves_the_former_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    replace_table(spark.range(3), path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stored, "_commit", lost)
        with pytest.raises(RuntimeError):
            replace_table(spark.range(9), path)
    former = read_table(spark, path)
    assert former.count() == 3
    assert replace_table(spark.range(5), path).count() == 5
    assert read_table(spark, path).count() == 5
    # Who reads the former table still can, until the next but one is there.
    assert former.count() == 3


SUPPLIES = {
    "fornecedores.csv": "id_fornecedor,razao_social,uf,criticidade,fornecedor_unico\nS1,Um,SP,Alta,true\n",
    "categorias_compra.csv": "id_categoria,nome,tipo\nC1,Cat,MRO\n",
    "contratos.csv": "contrato_id\nK1\n",
    "pedidos_compra.csv": "id_pedido,id_fornecedor,id_categoria,contrato_id,data_pedido,centro,valor_total,status\n"
                          "P1,S1,C1,K1,2024-01-01,X,10.00,ok\nP2,S2,C1,,2024-01-02,X,20.00,ok\nP3,S2,C2,,2024-01-03,X,30.00,ok\nP4,,C1,,2024-01-04,X,1.00,ok\n",
    "itens_pedido.csv": "id_pedido,id_item,descricao,qtd,preco_unitario,preco_baseline\nP1,1,d,1,10,11\n",
    "recebimentos.csv": "id_pedido,data_prometida,data_recebida,qtd_recebida,ok_qualidade\nP1,2024-01-05,2024-01-05,1,true\n",
}


def test_facts_are_repaired_when_their_dimension_lands(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    for name, text in SUPPLIES.items():
        (raw / name).write_text(text)
    source = lambda folder, name: (folder, f"{name}*.csv")

    def refresh():
        tables = refresh_case(spark, "suprimentos", str(raw), root, source=source)
        return {r.id_pedido: (r.razao_social, r.categoria_nome) for r in tables["silver_pedidos"].collect()}

    head = SUPPLIES["fornecedores.csv"].splitlines()[0]
    assert refresh() == {"P1": ("Um", "Cat"), "P2": (None, "Cat"), "P3": (None, None), "P4": (None, "Cat")}
    (raw / "fornecedores_2.csv").write_text(f"{head}\nS2,Dois,RJ,Baixa,false\n")
    written = sorted((tmp_path / "lake" / "silver_pedidos").rglob("*.parquet"))
    assert refresh() == {"P1": ("Um", "Cat"), "P2": ("Dois", "Cat"), "P3": ("Dois", None), "P4": (None, "Cat")}
    # No full refresh, and only the touched rows were made again.
    assert sorted((tmp_path / "lake" / "silver_pedidos").rglob("*.parquet")) == written
    repaired = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/repairs_pedidos/1/rows")
    assert sorted(r.id_pedido for r in repaired.collect()) == ["P2", "P3"]
    (raw / "categorias_compra_2.csv").write_text("id_categoria,nome,tipo\nC2,Dog,MRO\n")
    assert refresh() == {"P1": ("Um", "Cat"), "P2": ("Dois", "Cat"), "P3": ("Dois", "Dog"), "P4": (None, "Cat")}
    assert refresh()["P3"] == ("Dois", "Dog")


def test_a_consumer_syncs_over_several_versions(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "c")

    def commit(**rows):
        replace_table(spark.createDataFrame([*rows.items()] or [("x", 0)], "k string, v int").filter("v > 0"), path, kept=9)

    def synced():
        return {r.k: r.v for r in sync(spark, path, copy, ["k"]).collect()}

    commit(a=1, b=2, c=3)
    assert synced() == {"a": 1, "b": 2, "c": 3}
    commit(a=5, b=2, d=7)
    commit(a=6, d=8, e=9)
    net = {(r.k, r.v, r._change) for r in changes_between(spark, path, ["k"], 1, 3).collect()}
    assert net == {("a", 6, "update"), ("b", 2, "delete"), ("c", 3, "delete"), ("d", 8, "insert"), ("e", 9, "insert")}
    assert synced() == {"a": 6, "d": 8, "e": 9} and synced() == {"a": 6, "d": 8, "e": 9}
    assert {r._change for r in changes_between(spark, path, ["k"], 0, 3).collect()} == {"insert"}


def test_working_folder_comes_from_the_session(spark):
    from auriga.session import scratch, shared_root

    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from auriga.session import shared_root

    def session(master, **settings):
        conf = {"spark.sql.warehouse.dir": "file:/home/x/spark-warehouse"} | settings
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *_: conf.get(key)), sparkContext=SimpleNamespace(master=master))

    assert shared_root(session("local[8]")) == "file:/home/x/spark-warehouse"
    assert shared_root(session("yarn", **{"spark.checkpoint.dir": "hdfs://n/ck/"})) == "hdfs://n/ck"
    assert shared_root(session("yarn", **{"spark.sql.warehouse.dir": "s3a://b/w"})) == "s3a://b/w"
    with pytest.raises(ValueError):
        shared_root(session("spark://host:7077"))


def test_a_bad_value_is_rescued_and_stops_nothing(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    for name, text in RAW.items():
        (raw / name).write_text(text)
    lot = raw / "leituras_sensores_lote02.csv"
    lot.write_text(RAW["leituras_sensores_lote01.csv"].splitlines()[0] + "\n7,A1,ontem,50,3,2,900\n")
    (raw / "ativos_antigos.csv").write_text(RAW["ativos.csv"])
    tables = refresh_case(spark, "manutencao", str(raw), root)
    assert tables["bronze_ativos"].count() == 2
    assert tables["silver_leituras"].filter("id_leitura = '7' AND data_hora IS NULL").count() == 1
    assert [r._rescued_data for r in tables["rescued_leituras"].collect()] == ['{"data_hora":"ontem"}']
    assert tables["rescued_falhas"].count() == 0


def test_unknown_case_fails(spark, tmp_path):
    with pytest.raises(KeyError):
        refresh_case(spark, "outro", str(tmp_path), str(tmp_path))


def test_header_only_read_in_batch(spark, tmp_path):
    (tmp_path / "a.csv").write_text("um,dois\n1,2\n")
    assert files.scan_csv(spark, str(tmp_path)).columns[:2] == ["um", "dois"]
    assert files.scan_csv(spark, str(tmp_path)).filter(F.col("_ingested_at").isNull()).count() == 0
