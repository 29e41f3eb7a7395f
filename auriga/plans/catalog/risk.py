"""Features, labels, training and scoring (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auriga.operators import features, risk_model
from auriga.plans.oracle_tables import rnd

# Failures of this lake are random, so a model can hardly beat chance; it must not fall far below it.
AUC_FLOOR = 0.4

EXTRA = {
    "t_sums": """SELECT id_ativo, CAST(data_hora AS DATE) AS dia, sum(vibracao) AS v, sum(temperatura) AS t,
        count(*) AS n FROM t_readings GROUP BY ALL""",
    "t_features": f"""SELECT d.*, {rnd('sum(v) OVER w / sum(n) OVER w', 4)} AS vib_media_7d,
               {rnd('sum(t) OVER w / sum(n) OVER w', 4)} AS temp_media_7d
        FROM t_daily d JOIN t_sums USING (id_ativo, dia)
        WINDOW w AS (PARTITION BY d.id_ativo ORDER BY d.dia
                     RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
    "t_labelled": """SELECT f.*, CAST(EXISTS (SELECT 1 FROM t_failures x WHERE x.id_ativo = f.id_ativo
               AND x.data_falha BETWEEN f.dia + 1 AND f.dia + 7) AS INT) AS falha_proxima FROM t_features f""",
    "t_uplift": """SELECT id_falha, f.id_ativo, data_falha,
               sum(v) FILTER (WHERE dia < data_falha - 12) / sum(n) FILTER (WHERE dia < data_falha - 12) AS antes,
               sum(v) FILTER (WHERE dia >= data_falha - 12) / sum(n) FILTER (WHERE dia >= data_falha - 12) AS rampa
        FROM t_failures f JOIN t_sums s ON s.id_ativo = f.id_ativo AND dia <= data_falha GROUP BY ALL""",
}


def _fitted(c):
    training, held_out = risk_model.split_by_day(c.stored_labelled)
    return risk_model.train(training), held_out


def _quality_check(c):
    """Rows and classes of both parts, and whether the model ranks better than chance would by far."""
    training, held_out = risk_model.split_by_day(c.stored_labelled)
    measures = risk_model.measure(risk_model.train(training), held_out)
    auc_ok = measures.filter("nome = 'auc'").select(F.col("valor") > AUC_FLOOR).scalar()
    parts = training.withColumn("reservado", F.lit(False)).unionByName(held_out.withColumn("reservado", F.lit(True)))
    return parts.groupBy("reservado").agg(
        F.count("*").alias("linhas"), F.sum("falha_proxima").alias("positivos"), F.first(auc_ok).alias("auc_ok")
    )


def register(add_query) -> None:
    def add(name, build, sql=None):
        add_query(name, build, sql, **EXTRA)

    add("l1_daily_features", lambda c: c.features, "SELECT * FROM t_features")
    add("l2_failure_labels", lambda c: c.labelled, "SELECT * FROM t_labelled")
    add(
        "l3_class_weights",
        lambda c: features.balance_classes(c.labelled).select("id_ativo", "dia", "falha_proxima", "peso"),
        """SELECT id_ativo, dia, falha_proxima,
                  count(*) OVER () / CAST(2 * count(*) OVER (PARTITION BY falha_proxima) AS DOUBLE) AS peso
           FROM t_labelled""",
    )
    add("l4_model_quality", lambda c: risk_model.measure(*_fitted(c)))
    add(
        "l4_model_check",
        _quality_check,
        """SELECT dia > cut AS reservado, count(*) AS linhas, CAST(sum(falha_proxima) AS BIGINT) AS positivos, true AS auc_ok
           FROM t_labelled, (SELECT max(dia) - CAST(floor((max(dia) - min(dia)) * 0.3) AS INT) AS cut FROM t_labelled)
           GROUP BY 1""",
    )
    add(
        "l5_riskiest_assets",
        lambda c: risk_model.riskiest(
            risk_model.score_latest(risk_model.train(c.stored_labelled), c.stored_labelled)
        ),
    )
    add(
        "l5_scored_rows",
        lambda c: risk_model.score_latest(risk_model.train(c.stored_labelled), c.stored_labelled).select(
            "id_ativo", "tag", "dia", F.col("probabilidade_falha").between(0, 1).alias("probabilidade_ok")
        ),
        """SELECT id_ativo, tag, dia, true AS probabilidade_ok FROM t_labelled
           QUALIFY row_number() OVER (PARTITION BY id_ativo ORDER BY dia DESC) = 1""",
    )
    add(
        "l6_failure_uplift",
        lambda c: features.failure_uplift(c.readings, c.failures),
        f"""SELECT id_falha, id_ativo, data_falha, {rnd('antes', 2)} AS vib_antes, {rnd('rampa', 2)} AS vib_rampa,
                   {rnd('100 * (rampa / nullif(antes, 0) - 1)', 1)} AS aumento_pct
            FROM t_uplift WHERE antes IS NOT NULL AND rampa IS NOT NULL""",
    )
