"""Rules that look across payments, against plain loops."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auriga.operators import audit, audit_rules

SCHEMA = "id_transacao int, id_fornecedor string, data_transacao date, valor decimal(18,2)"
START = date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, START + timedelta(days=d), Decimal(a)) for i, (v, d, a) in enumerate(rows)], SCHEMA
    )


def split_ids(spark, rows):
    return sorted(r.id_transacao for r in audit_rules.split_findings(frame(spark, rows)).collect())


def expected_split(rows):
    found = []
    for vendor in {r[0] for r in rows}:
        mine = sorted((d, i, a) for i, (v, d, a) in enumerate(rows) if v == vendor and a < 50_000)
        for start, _, _ in mine:
            near = [(i, a) for d, i, a in mine if 0 <= d - start <= 10]
            if len(near) >= 3 and sum(a for _, a in near) >= 50_000:
                found += [i for i, _ in near]
                break
    return sorted(found)


def test_tenth_day_belongs_to_the_window(spark):
    assert split_ids(spark, [("a", d, 20_000) for d in (0, 5, 10)]) == [0, 1, 2]
    assert split_ids(spark, [("a", d, 20_000) for d in (0, 5, 11)]) == []


def test_same_day_payments_count(spark):
    assert split_ids(spark, [("a", 0, 20_000), ("a", 0, 20_000), ("a", 3, 20_000)]) == [0, 1, 2]


def test_only_the_first_cluster_of_a_vendor(spark):
    rows = [("a", d, 20_000) for d in (0, 1, 2, 40, 41, 42)]
    assert split_ids(spark, rows) == [0, 1, 2]


payment = st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.sampled_from([9_000, 18_000, 30_000, 49_999, 50_000]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payment, min_size=1, max_size=25))
def test_split_matches_a_plain_loop(spark, rows):
    assert split_ids(spark, rows) == expected_split(rows)


def test_duplicates_share_an_iso_week_across_the_year(spark):
    rows = spark.createDataFrame(
        [(1, "a", date(2024, 12, 30), Decimal(10)), (2, "a", date(2025, 1, 2), Decimal(10)),
         (3, "a", date(2025, 1, 6), Decimal(10)), (4, "b", date(2025, 1, 2), Decimal(10))],
        SCHEMA,
    )
    assert sorted(r.id_transacao for r in audit_rules.duplicate_findings(rows).collect()) == [1, 2]


def _full(spark, rows):
    """(id, value, limit, requester, approver, contracted, status, category, day)"""
    return spark.createDataFrame(
        [(i, "f", d, Decimal(v), Decimal(lim), req, app, has, "Regular", False, st_, cat, "Gerente")
         for i, v, lim, req, app, has, st_, cat, d in rows],
        "id_transacao int, id_fornecedor string, data_transacao date, valor decimal(18,2), alcada_limite decimal(18,2), "
        "id_solicitante int, id_aprovador int, fornecedor_possui_contrato boolean, situacao_cadastral string, "
        "fornecedor_parte_relacionada boolean, status string, categoria_despesa string, aprovador_cargo string",
    )


def test_flags_and_findings_differ_where_they_should(spark):
    from auriga.operators.silver import payment_flags

    saturday, monday = date(2024, 1, 6), date(2024, 1, 8)
    rows = [
        (1, "100", "200", 1, 2, True, "Pendente", "x", saturday),
        (2, "100", "200", 1, 2, True, "Pago", "x", saturday),
        (3, "250", "200", 1, 1, True, "Pago", None, monday),
        (4, "50000", "90000", 1, 2, False, "Pago", "Brindes e hospitalidade", monday),
    ]
    payments = _full(spark, rows).withColumns(payment_flags())
    found = audit_rules.payment_findings(payments)
    got = sorted((r.id_transacao, r.id_regra, float(r.valor_em_risco)) for r in found.collect())
    assert got == [
        (2, "R004", 0.0), (3, "R001", 50.0), (3, "R003", 250.0), (3, "R008", 0.0),
        (4, "R002", 50000.0), (4, "R009", 49000.0),
    ]
    texts = {(r.id_transacao, r.id_regra): r.descricao for r in found.collect()}
    assert texts[(4, "R009")] == "Brinde/hospitalidade de R$ 50.000,00 acima do teto de R$ 1.000,00."
    assert texts[(2, "R004")] == "Pagamento liquidado em sábado."
    unmatched = {(r.id_transacao, r.id_regra): r.situacao for r in audit.reconcile_flags(payments, found).collect()}
    assert unmatched[(1, "R004")] == "sem achado"
    assert unmatched[(3, "R001")] == "conforme"


def test_findings_that_carry_their_payment_equal_the_joined_ones(spark):
    from auriga.operators import silver

    saturday, monday = date(2024, 1, 6), date(2024, 1, 8)
    rows = [
        (1, "100", "200", 1, 2, True, "Pago", "x", saturday),
        (2, "100", "200", 1, 2, True, "Pago", "x", saturday),
        (3, "250", "200", 1, 1, True, "Pago", None, monday),
        (4, "50000", "90000", 1, 2, False, "Pago", "Brindes e hospitalidade", monday),
        *[(i, "9000", "90000", 1, 2, True, "Pago", "x", monday) for i in range(5, 12)],
    ]
    payments = _full(spark, rows).withColumns(silver.payment_flags()).selectExpr(
        "*", "if(id_transacao % 2 = 0, 'TI', NULL) AS area", "concat('Fornecedor ', id_transacao) AS razao_social"
    )
    rules = audit_rules.rule_catalogue(spark)
    joined = silver.enriched_findings(audit_rules.raise_findings(payments), rules, payments)
    carried = silver.enriched_findings(audit_rules.raise_findings(payments, silver.OF_PAYMENT), rules)
    columns = sorted(joined.columns)
    assert sorted(carried.columns) == columns
    rows = lambda df: sorted(map(str, df.select(columns).collect()))
    assert rows(carried) == rows(joined)
    assert {"R006", "R007", "R009"} <= {r.id_regra for r in carried.collect()}
