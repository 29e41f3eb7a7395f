"""The four cases as silver and gold tables over one lake.

A plain property builds a plan and runs nothing but size checks. A `stored_` one writes
its table once under the shared folder, as a refresh would, for plans with several passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.operators import (
    audit, audit_rules, documents, features, finance, maintenance, procurement, retrieval, silver,
)
from auriga.sources.lake import Lake, pick
from auriga.sources.stored import store_once


class Cases:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.lake = Lake(spark, path)

    # procurement
    @cached_property
    def orders(self) -> DataFrame:
        lake = self.lake
        return silver.enriched_orders(lake.purchase_orders(), lake.suppliers(), lake.purchase_categories())

    @cached_property
    def stored_orders(self) -> DataFrame:
        """The silver orders written once, for plans that first look up the newest date or the biggest suppliers."""
        return store_once(self.orders, "silver_pedidos")

    @cached_property
    def lines(self) -> DataFrame:
        return silver.priced_lines(self.lake.order_lines())

    @cached_property
    def receipts(self) -> DataFrame:
        return silver.timed_receipts(self.lake.receipts())

    @cached_property
    def delivery(self) -> DataFrame:
        return procurement.supplier_delivery(self.receipts, self.orders)

    # finance
    @cached_property
    def centers(self) -> DataFrame:
        return silver.clean_centers(self.lake.cost_centers())

    @cached_property
    def accounts(self) -> DataFrame:
        return silver.clean_accounts(self.lake.accounts())

    @cached_property
    def budget(self) -> DataFrame:
        return silver.enriched_ledger(
            self.lake.budget(), "id_orcamento", "valor_orcado", self.centers, self.accounts
        )

    @cached_property
    def actuals(self) -> DataFrame:
        return silver.enriched_ledger(
            self.lake.actuals(), "id_lancamento", "valor_realizado", self.centers, self.accounts
        )

    @cached_property
    def budget_base(self) -> DataFrame:
        return finance.budget_vs_actual(self.budget, self.actuals)

    @cached_property
    def stored_base(self) -> DataFrame:
        """The budget base written once, for plans that read it more than once."""
        return store_once(self.budget_base, "gold_orcado_vs_realizado")

    # maintenance
    @cached_property
    def assets(self) -> DataFrame:
        return silver.typed_assets(self.lake.assets())

    @cached_property
    def readings(self) -> DataFrame:
        return silver.enriched_readings(self.lake.readings(), self.lake.assets())

    @cached_property
    def failures(self) -> DataFrame:
        return silver.typed_failures(self.lake.failures())

    @cached_property
    def work_orders(self) -> DataFrame:
        return silver.typed_work_orders(self.lake.work_orders())

    @cached_property
    def daily(self) -> DataFrame:
        return maintenance.daily_telemetry(self.readings)

    @cached_property
    def stored_daily(self) -> DataFrame:
        return store_once(self.daily, "gold_telemetria_resumo")

    @cached_property
    def health(self) -> DataFrame:
        return maintenance.asset_health(self.readings, self.assets)

    @cached_property
    def mtbf(self) -> DataFrame:
        return maintenance.mean_time_between_failures(self.failures, self.assets)

    @cached_property
    def cost(self) -> DataFrame:
        return maintenance.maintenance_cost(self.work_orders, self.assets)

    @cached_property
    def risk(self) -> DataFrame:
        return maintenance.assets_at_risk(self.health, self.mtbf, self.work_orders)

    # audit
    @cached_property
    def rules(self) -> DataFrame:
        return audit_rules.rule_catalogue(self.spark)

    @cached_property
    def payments(self) -> DataFrame:
        lake = self.lake
        return silver.flagged_payments(lake.payments(), lake.suppliers(), lake.approvers())

    @cached_property
    def stored_payments(self) -> DataFrame:
        """The silver payments written once, for plans that pass over them several times.

        The rules that look across payments read them again, and so do the joins back.
        """
        return store_once(self.payments, "silver_transacoes")

    @cached_property
    def raised(self) -> DataFrame:
        """Findings with the four statuses spread by payment, standing in for the reviewers' work."""
        return self._raised()

    def _raised(self, carried: Sequence[str] = ()) -> DataFrame:
        reviewed = pick(audit_rules.STATUSES, F.col("id_transacao"))
        return audit_rules.raise_findings(self.stored_payments, carried).withColumn("status_achado", reviewed)

    @cached_property
    def stored_raised(self) -> DataFrame:
        return store_once(self.raised, "achados_auditoria")

    @cached_property
    def findings(self) -> DataFrame:
        return silver.enriched_findings(self._raised(silver.OF_PAYMENT), self.rules)

    @cached_property
    def ruled_findings(self) -> DataFrame:
        """Findings with their rules, for plans that need nothing of the payment."""
        return silver.ruled_findings(self.raised, self.rules)

    @cached_property
    def compliance(self) -> DataFrame:
        return audit.compliance_summary(self.stored_payments, self.raised)

    @cached_property
    def stored_compliance(self) -> DataFrame:
        summary = audit.compliance_summary(self.stored_payments, self.stored_raised)
        return store_once(summary, "gold_resumo_compliance")

    # documents
    @cached_property
    def chunks(self) -> DataFrame:
        """Every line of a text is a section; the texts of this lake carry no heading marks."""
        return documents.split_sections(self.lake.documents(), "\n")

    @cached_property
    def lexical_hits(self) -> DataFrame:
        return retrieval.lexical_top_k(self.lake.questions(), self.chunks)

    # features
    @cached_property
    def features(self) -> DataFrame:
        return features.daily_features(self.readings)

    @cached_property
    def labelled(self) -> DataFrame:
        return features.label_failures(self.features, self.failures)

    @cached_property
    def stored_labelled(self) -> DataFrame:
        """Labelled features written once: splitting, weighting, training and scoring each read them."""
        return store_once(self.labelled, "gold_features")
