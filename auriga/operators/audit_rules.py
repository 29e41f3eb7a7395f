"""The ten compliance rules over flagged payments, and the findings they raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from auriga.functions.columns import TOTAL, amount, brazilian
from auriga.operators.silver import CONTRACT_FLOOR

# Limits of the rules.
GIFT_CATEGORY = "Brindes e hospitalidade"
GIFT_LIMIT = 1_000
SPLIT_DAYS = 10
SPLIT_PAYMENTS = 3

# Fixed values but for the descriptions: the rule catalogue (id, name, description, severity, category, policy document).
RULES = [
    ("R001", "Alçada de aprovação excedida",
     "O valor do pagamento passa do limite de quem o aprovou.",
     "Alta", "Alçada", "norma_alcadas_aprovacao.md"),
    ("R002", "Pagamento a fornecedor sem contrato vigente",
     "Pagamento a partir do piso contratual para um fornecedor sem contrato.",
     "Alta", "Contrato", "politica_compras.md"),
    ("R003", "Quebra de segregação de funções",
     "Quem solicitou o pagamento também o aprovou.",
     "Alta", "Segregação de funções", "politica_segregacao_funcoes.md"),
    ("R004", "Pagamento processado em dia não útil",
     "Pagamento já pago com data de sábado ou domingo.",
     "Baixa", "Pagamento", "politica_pagamentos.md"),
    ("R005", "Fornecedor com situação cadastral irregular",
     "O cadastro do fornecedor pago está irregular.",
     "Alta", "Cadastro", "norma_due_diligence_fornecedores.md"),
    ("R006", "Indício de fracionamento de compra",
     "Em dez dias, pagamentos abaixo do piso contratual ao mesmo fornecedor somam o piso ou mais.",
     "Média", "Fracionamento", "politica_compras.md"),
    ("R007", "Indício de pagamento em duplicidade",
     "Mesmo fornecedor e mesmo valor mais de uma vez entre segunda-feira e domingo.",
     "Alta", "Pagamento", "politica_pagamentos.md"),
    ("R008", "Lançamento sem categoria de despesa",
     "O pagamento não informa a categoria da despesa.",
     "Baixa", "Cadastro", "manual_compliance.md"),
    ("R009", "Brinde ou hospitalidade acima do limite",
     "Gasto com brinde ou hospitalidade maior que o teto por pagamento.",
     "Média", "Conduta", "politica_brindes_hospitalidade.md"),
    ("R010", "Transação com parte relacionada",
     "O fornecedor pago consta como parte relacionada.",
     "Alta", "Conduta", "politica_conflito_interesses.md"),
]
RULE_COLUMNS = ["id_regra", "nome", "descricao", "severidade", "categoria", "politica_referencia"]

# Wording of the findings.
WORDING = {
    "R001": "Valor de R$ %s acima da alçada do aprovador (%s, limite R$ %s).",
    "R002": "Pagamento de R$ %s a fornecedor sem contrato vigente (acima do limite de R$ %s).",
    "R003": "Solicitante e aprovador são o mesmo colaborador.",
    "R004": "Pagamento liquidado em %s.",
    "R005": "Fornecedor com situação cadastral irregular na due diligence.",
    "R006": "Possível fracionamento: %d pagamentos ao mesmo fornecedor em 10 dias somando R$ %s.",
    "R007": "Pagamento de R$ %s ao mesmo fornecedor repetido na semana.",
    "R008": "Lançamento sem categoria de despesa.",
    "R009": "Brinde/hospitalidade de R$ %s acima do teto de R$ %s.",
    "R010": "Pagamento a fornecedor sinalizado como parte relacionada.",
}
STATUSES = ["Aberto", "Em análise", "Resolvido", "Falso positivo"]

FINDING = ["id_transacao", "id_regra", "data_deteccao", "valor_em_risco", "descricao"]


def rule_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_COLUMNS)


def single_payment_rules() -> dict[str, tuple[Column, Column, Column]]:
    """Rules that look at one payment: (condition, value at risk, wording)."""
    value, limit = F.col("valor"), F.col("alcada_limite")
    nothing = F.lit(0)
    day_name = F.when(F.dayofweek("data_transacao") == 7, "sábado").otherwise("domingo")
    return {
        "R001": (F.col("acima_alcada"), value - limit,
                 F.format_string(WORDING["R001"], brazilian(value), F.col("aprovador_cargo"), brazilian(limit))),
        "R002": (F.col("sem_contrato_relevante"), value,
                 F.format_string(WORDING["R002"], brazilian(value), brazilian(F.lit(CONTRACT_FLOOR)))),
        "R003": (F.col("sod_violado"), value, F.lit(WORDING["R003"])),
        "R004": (F.col("dia_nao_util") & (F.col("status") == "Pago"), nothing,
                 F.format_string(WORDING["R004"], day_name)),
        "R005": (F.col("fornecedor_irregular"), value, F.lit(WORDING["R005"])),
        "R008": (F.col("sem_categoria"), nothing, F.lit(WORDING["R008"])),
        "R009": ((F.col("categoria_despesa") == GIFT_CATEGORY) & (value > GIFT_LIMIT), value - GIFT_LIMIT,
                 F.format_string(WORDING["R009"], brazilian(value), brazilian(F.lit(GIFT_LIMIT)))),
        "R010": (F.col("parte_relacionada"), value, F.lit(WORDING["R010"])),
    }


def payment_findings(
    payments: DataFrame, rules: list[str] | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """All single-payment rules in one scan: at most one finding per rule and payment.

    The wording is added after the rules are unfolded, so a plan that only counts never formats it.
    Columns of the payment named in `carried` stay beside the finding.
    """
    chosen = {k: v for k, v in single_payment_rules().items() if rules is None or k in rules}
    raised = F.array(
        *[
            F.when(condition, F.struct(F.lit(rule).alias("id_regra"), amount(risk).alias("valor_em_risco")))
            for rule, (condition, risk, _) in chosen.items()
        ]
    )
    text = F.coalesce(*[F.when(F.col("id_regra") == rule, wording) for rule, (_, _, wording) in chosen.items()])
    found = payments.select("*", F.inline(F.array_compact(raised)))
    return found.withColumns({"data_deteccao": F.col("data_transacao"), "descricao": text}).select(*FINDING, *carried)


def split_clusters(payments: DataFrame) -> DataFrame:
    """R006 per vendor: the first day whose ten-day window holds enough small payments.

    Payments fold to one row per vendor and day first, so the window sorts at most one
    row per calendar day for a vendor, however many payments it has.
    """
    small = payments.filter(F.col("valor") < CONTRACT_FLOOR)
    daily = small.groupBy("id_fornecedor", "data_transacao").agg(
        F.count("*").alias("_n"), total_value().alias("_value")
    )
    ahead = (
        Window.partitionBy("id_fornecedor")
        .orderBy(F.unix_date("data_transacao"))
        .rangeBetween(Window.currentRow, SPLIT_DAYS)
    )
    windows = daily.select(
        "id_fornecedor",
        F.col("data_transacao").alias("inicio"),
        F.sum("_n").over(ahead).alias("n_pagamentos"),
        F.sum("_value").over(ahead).cast(TOTAL).alias("soma"),
    )
    return (
        windows.filter((F.col("n_pagamentos") >= SPLIT_PAYMENTS) & (F.col("soma") >= CONTRACT_FLOOR))
        .groupBy("id_fornecedor")
        .agg(F.min_by(F.struct("inicio", "n_pagamentos", "soma"), "inicio").alias("_first"))
        .select("id_fornecedor", "_first.*")
    )


def total_value() -> Column:
    return F.sum("valor").cast(TOTAL)


def split_findings(payments: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The payments of each cluster. Joining on vendor and day spreads a busy vendor."""
    days = split_clusters(payments).select(
        "id_fornecedor", "n_pagamentos", "soma",
        F.explode(F.sequence("inicio", F.date_add("inicio", SPLIT_DAYS))).alias("data_transacao"),
    )
    small = payments.filter(F.col("valor") < CONTRACT_FLOOR).select(
        *dict.fromkeys(["id_transacao", "id_fornecedor", "data_transacao", "valor", *carried])
    )
    text = F.format_string(WORDING["R006"], "n_pagamentos", brazilian(F.col("soma")))
    return small.join(days, ["id_fornecedor", "data_transacao"]).select(
        "id_transacao",
        F.lit("R006").alias("id_regra"),
        F.col("data_transacao").alias("data_deteccao"),
        F.col("valor").alias("valor_em_risco"),
        text.alias("descricao"),
        *carried,
    )


def duplicate_findings(payments: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """R007: same vendor, value and ISO week. Two dates share a week when they share its Monday.

    Groups are counted with partial aggregation and joined back, never held in one task.
    """
    keys = ["id_fornecedor", "valor", "_monday"]
    weekly = payments.select(
        *dict.fromkeys(["id_transacao", "id_fornecedor", "valor", "data_transacao", *carried]),
        F.date_trunc("week", F.col("data_transacao").cast("timestamp_ntz")).cast("date").alias("_monday"),
    )
    repeated = weekly.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= 2)
    return weekly.join(repeated, keys, "left_semi").select(
        "id_transacao",
        F.lit("R007").alias("id_regra"),
        F.col("data_transacao").alias("data_deteccao"),
        F.col("valor").alias("valor_em_risco"),
        F.format_string(WORDING["R007"], brazilian(F.col("valor"))).alias("descricao"),
        *carried,
    )


def raise_findings(payments: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Every finding of the ten rules. The id is made of payment and rule, so no global numbering.

    Columns of the payment named in `carried` stay beside the finding, so that it need not be joined back.
    """
    found = (
        payment_findings(payments, carried=carried)
        .unionByName(split_findings(payments, carried))
        .unionByName(duplicate_findings(payments, carried))
    )
    return found.withColumns(
        {
            "id_achado": F.concat_ws("-", F.lit("AC"), F.col("id_transacao").cast("string"), "id_regra"),
            "status_achado": F.lit(STATUSES[0]),
        }
    )
