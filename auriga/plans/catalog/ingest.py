"""Sources, streams and refreshes (S). Raw files are written from the case tables first."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import functions as F

from auriga.operators import changes, documents, quality
from auriga.plans.catalog.checks import raw_tables
from auriga.plans.catalog.texts import EXTRA as TEXTS
from auriga.plans.refresh import CASES, refresh_bronze, refresh_case, refresh_gold, refresh_silver
from auriga.session import scratch
from auriga.sources import files
from auriga.sources.stored import replace_table
from auriga.streaming.first_rows import first_rows, refresh_first_rows
from auriga.streaming.tables import StreamTable
from auriga.streaming.telemetry import refresh_daily_telemetry

SUPPLIER_COLUMNS = [
    "id_fornecedor", "razao_social", "uf", "criticidade", "fornecedor_unico", "possui_contrato",
    "situacao_cadastral", "parte_relacionada",
]

BUNDLE = 200
BUNDLED = "array<struct<doc_nome:string,texto:string>>"


def folder_source(raw: str, name: str) -> tuple[str, str]:
    """Spark writes a folder per raw table."""
    return f"{raw}/{name}", "*.csv"


def write_raw(c, case: str, raw: str, tables: Collection[str] | None = None) -> str:
    """The raw files of all bronze tables of a case, or of those among `tables`."""
    names = None if tables is None else [t.removeprefix("bronze_") for t in tables if t.startswith("bronze_")]
    for name, df in raw_tables(c, case, names).items():
        files.write_csv(df, f"{raw}/{name}")
    return raw


def _lots(c) -> dict:
    """Readings in three deliveries by day of the month."""
    lot = F.least(F.lit(3), F.ceil(F.dayofmonth("data_hora") / 10)).cast("int")
    readings = c.lake.readings().withColumn("_lot", lot)
    return {n: readings.filter(F.col("_lot") == n).drop("_lot") for n in (1, 2, 3)}


def _scan_suppliers(c):
    folder = scratch(c.spark, "csv")
    files.write_csv(c.lake.suppliers().select(*SUPPLIER_COLUMNS), folder)
    return files.scan_csv(c.spark, folder)


def _pattern_scan(c):
    folder = scratch(c.spark, "lots")
    for n, lot in _lots(c).items():
        files.write_csv(lot, f"{folder}/leituras_lote0{n}")
    scanned = files.scan_csv(c.spark, f"{folder}/leituras_lote0[12]")
    return scanned.select("id_leitura", "id_ativo", "vibracao")


def _incremental(c):
    """Two deliveries, a third one, then a refresh with nothing new."""
    raw, root = scratch(c.spark, "lots"), scratch(c.spark, "tables")
    table, lots = StreamTable(c.spark, root, "bronze_leituras_sensores"), _lots(c)
    counts = []

    def load(step: str) -> None:
        table.refresh(files.stream_csv(c.spark, f"{raw}/leituras_lote*"))
        counts.append((step, table.read().count()))

    files.write_csv(lots[1], f"{raw}/leituras_lote01")
    files.write_csv(lots[2], f"{raw}/leituras_lote02")
    load("lotes 1 e 2")
    files.write_csv(lots[3], f"{raw}/leituras_lote03")
    load("lote 3")
    load("sem novidade")
    return c.spark.createDataFrame(counts, "etapa string, linhas bigint")


def _full_refresh(c):
    raw, root = scratch(c.spark, "csv"), scratch(c.spark, "tables")
    files.write_csv(c.lake.payments(), raw)
    table = StreamTable(c.spark, root, "bronze_transacoes")
    rows = []
    for full in (False, False, True):
        table.refresh(files.stream_csv(c.spark, raw), full)
        rows.append((table.version, table.read().count()))
    return c.spark.createDataFrame(rows, "versao int, linhas bigint")


def _rescued(c):
    raw = c.lake.purchase_orders().select(
        *[F.col(n).cast("string").alias(n) for n in ("id_pedido", "data_pedido", "valor_total", "contrato_id")]
    )
    return files.cast_or_rescue(
        raw,
        {"id_pedido": "bigint", "data_pedido": "date", "valor_total": "decimal(18,2)", "contrato_id": "int"},
    )


def _whole_texts(c):
    """Named texts bundled a few hundred per file, as JSON, and told apart again after the whole-file scan.

    A file per text would not survive a large table; bundles keep files and rows bounded.
    """
    scanned = files.whole_texts(c.spark, _write_bundles(c), "part-*", "lote=([^/]+)/[^/]+$")
    texts = scanned.select(F.col("doc_nome").alias("lote"), F.explode(F.from_json("texto", BUNDLED)).alias("t"))
    return texts.select("lote", "t.doc_nome", "t.texto")


def _binary_files(c):
    """The same bundles scanned as bytes, and decoded."""
    scanned = files.binary_files(c.spark, _write_bundles(c), "part-*").filter("length = octet_length(content)")
    decoded = F.from_json(F.decode("content", "UTF-8"), BUNDLED)
    return scanned.select(F.explode(decoded).alias("t")).select("t.doc_nome", "t.texto")


def _write_bundles(c) -> str:
    folder = scratch(c.spark, "texts")
    named = c.lake.documents().select("doc_nome", "texto")
    number = F.floor(F.substring("doc_nome", 5, 20).cast("bigint") / BUNDLE)
    bundles = named.groupBy(F.concat(F.lit("lote-"), number.cast("string")).alias("lote")).agg(
        F.to_json(F.collect_list(F.struct("doc_nome", "texto"))).alias("value")
    )
    bundles.write.partitionBy("lote").text(folder)
    return folder


_REFRESHED: dict[tuple, tuple[str, str, dict]] = {}


def refreshed(c, case: str, wanted: Collection[str] | None = None) -> dict:
    """The tables of a case, or those wanted and what they are made of.

    One refresh of a table per application, lake and case, shared by all queries on its layers.
    """
    layers, spark = CASES[case], c.spark
    key = (spark.sparkContext.applicationId, c.lake.path, case)
    # Taken out while it is worked on: after a refresh that failed, the next one starts in new folders.
    raw, root, tables = _REFRESHED.pop(key, None) or (scratch(spark, f"raw-{case}"), scratch(spark, "tables"), {})
    missing = layers.needed(layers.tables() if wanted is None else wanted) - tables.keys()
    if missing:
        write_raw(c, case, raw, missing)
        bronze = tables | refresh_bronze(spark, case, raw, root, source=folder_source, only=missing)
        silver = refresh_silver(spark, case, root, bronze, only=missing)
        tables = refresh_gold(spark, case, root, silver, missing)
    _REFRESHED[key] = raw, root, tables
    return tables


def _layer(c, case: str, table: str, direct):
    """A refreshed table with its ids, text in raw files, in the types of the plan over the lake."""
    found = refreshed(c, case, [table])[table]
    return found.select(*[F.col(name).cast(kind).alias(name) for name, kind in direct(c).dtypes])


_LAYERS = {
    "suprimentos": {
        "silver_pedidos": "v1_enriched_orders", "silver_itens": "v2_priced_lines", "silver_recebimentos": "v3_timed_receipts",
        "gold_gasto_categoria": "p1_category_spend", "gold_lead_time_fornecedor": "p2_supplier_delivery",
        "gold_saving": "p3_category_saving", "gold_aderencia_contrato": "p4_contract_coverage",
        "gold_fornecedor_unico": "p5_sole_source_spend"},
    "financas": {
        "silver_centros": "v4_cost_centers", "silver_contas": "v4_accounts", "silver_orcamento": "v5_budget",
        "silver_realizado": "v5_actuals", "gold_orcado_vs_realizado": "f1_budget_vs_actual",
        "gold_variacao_budget": "f2_budget_variance", "gold_despesa_categoria": "f3_expense_by_group",
        "gold_receita_mensal": "f4_monthly_revenue", "gold_topo_estouros": "f5_top_overruns"},
    "manutencao": {
        "silver_ativos": "v6_assets", "silver_falhas": "v6_failures", "silver_ordens": "v6_work_orders",
        "silver_leituras": "v7_readings", "gold_telemetria_resumo": "m1_daily_telemetry", "gold_saude_ativo": "m2_asset_health",
        "gold_mtbf": "m3_time_between_failures", "gold_custo_manutencao": "m4_maintenance_cost",
        "gold_ativos_risco": "m5_assets_at_risk"},
    "auditoria": {
        "silver_transacoes": "v8_flagged_payments", "silver_achados": "v9_enriched_findings",
        "gold_achados": "a1_findings_by_rule", "gold_violacoes_alcada": "a2_limit_violations",
        "gold_gasto_sem_contrato": "a3_uncontracted_spend", "gold_resumo_compliance": "a4_compliance_summary"},
}


def _chunk_snapshots(c) -> list:
    """A folder of texts becomes chunks twice, the second time with some texts edited, dropped and added."""
    number = F.substring("doc_nome", 5, 20).cast("bigint")
    first = c.lake.documents().filter(number % 10 != 0)
    second = c.lake.documents().filter(number % 10 != 1).withColumn(
        "texto", F.when(number % 10 == 2, F.concat("texto", F.lit("\nnota"))).otherwise(F.col("texto"))
    )
    return [documents.split_sections(texts, "\n") for texts in (first, second)]


def _chunk_changes(c) -> list:
    return [replace_table(chunks, scratch(c.spark, "chunks")) for chunks in _chunk_snapshots(c)]


def _searched_corpus(c):
    """The searched copy brought up to date by the feed alone."""
    before, after = _chunk_changes(c)
    feed = replace_table(changes.change_feed(before, after, ["chunk_id"]), scratch(c.spark, "feed"))
    return changes.apply_changes(before, feed, ["chunk_id"])


def _synced_corpus(c):
    """A consumer that stood at the first of four versions reaches the newest in one sync.

    Both snapshots are written as versions of the table at once.
    """
    root = scratch(c.spark, "versions")
    path, copy = f"{root}/corpus", f"{root}/copy"
    first, last = _chunk_snapshots(c)
    first = replace_table(first, path, kept=9)
    changes.sync(c.spark, path, copy, ["chunk_id"])
    halfway = first.withColumn("texto", F.concat("texto", F.lit("?"))).filter(F.xxhash64("chunk_id") % 3 != 0)
    for snapshot in (halfway, first.limit(0), last):
        replace_table(snapshot, path, kept=9)
    return changes.sync(c.spark, path, copy, ["chunk_id"])


def _changed_sections(condition: str, text: str) -> str:
    return f"""
    SELECT doc_nome || '#' || i AS chunk_id, doc_nome, politica, CAST(i AS INT) AS secao_idx,
           CASE WHEN i = 0 THEN p ELSE p END AS texto
    FROM (SELECT doc_nome, politica, unnest(s) AS p, unnest(range(len(s))) AS i
          FROM (SELECT *, string_split({text}, chr(10)) AS s FROM t_docs
                WHERE CAST(substr(doc_nome, 5) AS BIGINT) % 10 {condition})) WHERE length(trim(p)) > 0"""


def _replace_twice(c):
    path = f"{scratch(c.spark, 'tables')}/categorias"
    replace_table(c.lake.purchase_categories(), path)
    return replace_table(c.lake.purchase_categories(), path)


def _bronze(c, case: str):
    raw, root = write_raw(c, case, scratch(c.spark, f"raw-{case}")), scratch(c.spark, "tables")
    tables = refresh_bronze(c.spark, case, raw, root, source=folder_source)
    return quality.row_counts("bronze", {n: tables[f"bronze_{n}"] for n in CASES[case].bronze})


def _daily_stream(c):
    """Two deliveries; the second one brings late readings of days that the first one already gave."""
    root = scratch(c.spark, "telemetry")
    late = F.pmod(F.xxhash64("id_leitura"), F.lit(5)) == 0
    for delivery in (c.readings.filter(~late), c.readings.filter(late)):
        delivery.write.mode("append").parquet(f"{root}/readings")
        readings = c.spark.readStream.schema(c.readings.schema).parquet(f"{root}/readings")
        refresh_daily_telemetry(readings, f"{root}/daily", f"{root}/checkpoint")
    return c.spark.read.parquet(f"{root}/daily")


KEYS = ["id_pedido", "id_item"]
ORDER = ["valor_item", "saving_item", "descricao", "qtd"]


def _streamed_first(c):
    """Order lines in three deliveries, the later ones with repeats and with rows that sort before those delivered."""
    root, part = scratch(c.spark, "first"), F.pmod(F.xxhash64(*ORDER), F.lit(4))
    for delivery in (c.lines.filter(part > 1), c.lines.filter(part != 2), c.lines.filter(part < 3)):
        delivery.write.mode("append").parquet(f"{root}/lines")
        lines = c.spark.readStream.schema(c.lines.schema).parquet(f"{root}/lines")
        refresh_first_rows(lines, KEYS, ORDER, f"{root}/table", f"{root}/checkpoint")
    return first_rows(c.spark, KEYS, f"{root}/table").select(*c.lines.columns)


def _late_suppliers(c):
    """Orders before every third of their suppliers, then the suppliers, by two refreshes."""
    wanted = ["silver_pedidos"]
    needed = CASES["suprimentos"].needed(wanted) - {"bronze_fornecedores"}
    raw, root = write_raw(c, "suprimentos", scratch(c.spark, "raw-suprimentos"), needed), scratch(c.spark, "tables")
    every = c.lake.suppliers()
    late = F.pmod(F.xxhash64("id_fornecedor"), F.lit(3)) == 0
    files.write_csv(every.filter(~late), f"{raw}/fornecedores")
    refresh_case(c.spark, "suprimentos", raw, root, source=folder_source, wanted=wanted)
    files.write_csv(every.filter(late), f"{raw}/fornecedores/late")
    found = refresh_case(c.spark, "suprimentos", raw, root, source=_with_late, wanted=wanted)["silver_pedidos"]
    return found.select(*[F.col(name).cast(kind).alias(name) for name, kind in c.orders.dtypes])


def _with_late(raw: str, name: str) -> tuple[str, str]:
    """Suppliers come from a second folder too."""
    return (f"{raw}/{name}{{,/late}}" if name == "fornecedores" else f"{raw}/{name}"), "*.csv"


_BRONZE = {
    "s14_bronze_suprimentos": ("suprimentos", [
        ("fornecedores", "t_suppliers"), ("categorias_compra", "t_categories"),
        ("contratos", "(SELECT DISTINCT contrato_id FROM t_orders WHERE contrato_id IS NOT NULL)"),
        ("pedidos_compra", "t_orders"), ("itens_pedido", "t_lines"), ("recebimentos", "t_receipts")]),
    "s15_bronze_financas": ("financas", [
        ("centros_custo", "t_centers"), ("contas_contabeis", "t_accounts"), ("orcamento", "t_budget"),
        ("lancamentos", "t_actuals")]),
    "s16_bronze_manutencao": ("manutencao", [
        ("ativos", "t_assets"), ("falhas", "t_failures"), ("ordens_manutencao", "t_work"),
        ("leituras_sensores", "t_readings")]),
    "s17_bronze_auditoria": ("auditoria", [
        ("fornecedores", "t_suppliers"), ("aprovadores", "t_approvers"), ("regras_compliance", "t_rules"),
        ("transacoes", "t_payments"), ("achados_auditoria", "t_raised")]),
}


def register(add) -> None:
    as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SUPPLIER_COLUMNS)
    add(
        "s1_csv_scan",
        lambda c: _scan_suppliers(c).select(*SUPPLIER_COLUMNS, files.RESCUED),
        f"SELECT {as_text}, CAST(NULL AS VARCHAR) AS _rescued_data FROM t_suppliers",
    )
    add(
        "s2_pattern_scan",
        _pattern_scan,
        """SELECT CAST(id_leitura AS VARCHAR) AS id_leitura, CAST(id_ativo AS VARCHAR) AS id_ativo,
                  CAST(vibracao AS VARCHAR) AS vibracao FROM t_readings WHERE day(data_hora) <= 20""",
    )
    add(
        "s3_incremental_ingest",
        _incremental,
        """SELECT 'lotes 1 e 2' AS etapa, count(*) AS linhas FROM t_readings WHERE day(data_hora) <= 20
           UNION ALL SELECT 'lote 3', count(*) FROM t_readings
           UNION ALL SELECT 'sem novidade', count(*) FROM t_readings""",
    )
    add(
        "s4_ingestion_time",
        lambda c: _scan_suppliers(c).agg(
            F.count("*").alias("linhas"), F.count(files.INGESTED).alias("com_data"),
            F.count_distinct(files.INGESTED).alias("cargas"),
        ),
        "SELECT count(*) AS linhas, count(*) AS com_data, CAST(1 AS BIGINT) AS cargas FROM t_suppliers",
    )
    add(
        "s5_rescued_data",
        _rescued,
        """SELECT id_pedido, data_pedido, valor_total, CAST(NULL AS INT) AS contrato_id,
                  CASE WHEN contrato_id IS NOT NULL THEN '{"contrato_id":"' || contrato_id || '"}' END AS _rescued_data
           FROM t_orders""",
    )
    add(
        "s6_whole_texts",
        _whole_texts,
        f"""SELECT 'lote-' || (doc_id // {BUNDLE}) AS lote, 'doc-' || doc_id AS doc_nome, text AS texto FROM documents""",
    )
    add(
        "s7_binary_files",
        _binary_files,
        "SELECT 'doc-' || doc_id AS doc_nome, text AS texto FROM documents",
    )
    from auriga.plans.catalog import tables as direct

    plans: dict = {}
    direct.register(lambda name, build, sql=None: plans.__setitem__(name, (build, sql)))
    for case, layers in _LAYERS.items():
        for table, key in layers.items():
            build, sql = plans[key]
            prefix = "s8" if table.startswith("silver") else "s9"
            add(
                f"{prefix}_{table}",
                lambda c, case=case, table=table, build=build: _layer(c, case, table, build),
                sql,
            )
    edited = "CASE WHEN CAST(substr(doc_nome, 5) AS BIGINT) % 10 = 2 THEN texto || chr(10) || 'nota' ELSE texto END"
    old, new = _changed_sections("<> 0", "texto"), _changed_sections("<> 1", edited)
    fields = ("doc_nome", "politica", "secao_idx", "texto")
    add(
        "s13_chunk_changes",
        lambda c: changes.change_feed(*_chunk_changes(c), ["chunk_id"]),
        f"""SELECT chunk_id, {', '.join(f'CASE WHEN n.chunk_id IS NULL THEN o.{f} ELSE n.{f} END AS {f}' for f in fields)},
                   CASE WHEN o.chunk_id IS NULL THEN 'insert' WHEN n.chunk_id IS NULL THEN 'delete' ELSE 'update' END AS _change
            FROM ({old}) o FULL JOIN ({new}) n USING (chunk_id)
            WHERE o.chunk_id IS NULL OR n.chunk_id IS NULL OR ({' OR '.join(f'o.{f} IS DISTINCT FROM n.{f}' for f in fields)})""",
        **TEXTS,
    )
    add("s13_searched_corpus", _searched_corpus, new, **TEXTS)
    add("s13_synced_corpus", _synced_corpus, new, **TEXTS)
    add("v1_repaired_orders", _late_suppliers, "SELECT * FROM t_orders")
    add(
        "s10_replace_table",
        _replace_twice,
        "SELECT id_categoria, categoria_nome AS nome, categoria_tipo AS tipo FROM t_categories",
    )
    add(
        "s11_full_refresh",
        _full_refresh,
        """SELECT CAST(v AS INT) AS versao, (SELECT count(*) FROM t_payments) AS linhas
           FROM (VALUES (1), (1), (2)) AS t(v)""",
    )
    for key, (case, tables) in _BRONZE.items():
        add(
            key,
            lambda c, case=case: _bronze(c, case),
            "\nUNION ALL ".join(
                f"SELECT 'bronze' AS camada, '{name}' AS tabela, count(*) AS linhas FROM {table}"
                for name, table in tables
            ),
        )
    add(
        "v10_streaming_keep_first",
        _streamed_first,
        """SELECT * FROM t_lines QUALIFY row_number() OVER (
             PARTITION BY id_pedido, id_item ORDER BY valor_item, saving_item, descricao, qtd) = 1""",
    )
    add(
        "m1_daily_telemetry_stream",
        _daily_stream,
        "SELECT * FROM t_daily",
    )
