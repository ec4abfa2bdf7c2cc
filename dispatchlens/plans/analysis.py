"""The analysis as a whole: from raw tables to every result, lazily."""

from __future__ import annotations

import copy
from collections.abc import Iterable, Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dispatchlens.functions.months import month_argument
from dispatchlens.operators import cleaning, detection, facts, investigation
from dispatchlens.plans.shared import materialise
from dispatchlens.settings import Settings


class Analysis:
    """DataFrames of one data set.

    Nothing runs until a result is used.  Each property composes only the inputs
    its result needs: the drill-down, for instance, joins orders to the issues'
    months before it looks up states, sellers or reviews.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        settings: Settings = Settings(),
        manual_translations: dict[str, str] | None = None,
    ) -> None:
        self.raw = raw
        self.settings = settings
        self.manual = manual_translations

    # Cleaned tables

    @cached_property
    def customers(self) -> DataFrame:
        return cleaning.clean_customers(self.raw["customers"])

    @cached_property
    def sellers(self) -> DataFrame:
        return cleaning.clean_sellers(self.raw["sellers"])

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.clean_products(
            self.raw["products"], self.raw["category_translation"], self.manual
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return cleaning.clean_order_items(self.raw["order_items"])

    @cached_property
    def payment_records(self) -> DataFrame:
        """Payments without the flags that concern the whole order."""
        return cleaning.clean_payments(self.raw["payments"])

    @cached_property
    def payment_sequences(self) -> DataFrame:
        return cleaning.payment_sequences(self.payment_records)

    @cached_property
    def payments(self) -> DataFrame:
        return cleaning.payment_flags(self.payment_records)

    @cached_property
    def reviews(self) -> DataFrame:
        return cleaning.clean_reviews(self.raw["reviews"])

    @cached_property
    def timed_orders(self) -> DataFrame:
        """Orders with what an order row alone decides."""
        return cleaning.order_timing(self.raw["orders"], self.settings)

    @cached_property
    def orders(self) -> DataFrame:
        return cleaning.clean_orders(
            self.raw["orders"], self.order_items, self.payment_records, self.settings
        )

    def clean_tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "sellers": self.sellers,
            "orders": self.orders,
            "order_items": self.order_items,
            "payments": self.payments,
            "reviews": self.reviews,
        }

    # Facts and detection

    @cached_property
    def order_measures(self) -> DataFrame:
        """What the KPIs read of an order."""
        return facts.order_measures(
            self.timed_orders, self.order_items, self.payment_records, self.reviews, flags=False
        )

    @cached_property
    def order_facts(self) -> DataFrame:
        return facts.order_facts(
            self.timed_orders, self.customers, self.order_items, self.payment_records, self.reviews
        )

    @cached_property
    def monthly_kpis(self) -> DataFrame:
        return facts.monthly_kpis(self.order_measures, self.settings)

    @cached_property
    def monthly_comparison(self) -> DataFrame:
        return detection.monthly_comparison(self.monthly_kpis)

    @cached_property
    def delivery_comparisons(self) -> DataFrame:
        return detection.delivery_comparisons(self.monthly_comparison, self.settings)

    @cached_property
    def delivery_issues(self) -> DataFrame:
        return detection.delivery_issues(self.delivery_comparisons)

    def views(self) -> dict[str, DataFrame]:
        return {
            "order_facts": self.order_facts,
            "monthly_kpis": self.monthly_kpis,
            "monthly_delivery_comparison": self.monthly_comparison,
        }

    def view_sources(self) -> dict[str, DataFrame]:
        """What each view has a row for: the orders, the window's months that have any,
        and those of them with a month before.
        """
        inside = cleaning.in_window(F.col("order_purchase_timestamp"), self.settings)
        months = self.timed_orders.filter(inside).select("purchase_month").distinct()
        first = F.min("purchase_month").over(Window.partitionBy())
        later = months.withColumn("first", first).filter("purchase_month > first")
        return {
            "order_facts": self.orders,
            "monthly_kpis": months,
            "monthly_delivery_comparison": later,
        }

    # Drill-down

    def issue_keys(self, month: str | date | None = None) -> DataFrame:
        """Key columns of all issues, or of the one of ``month``."""
        issues = investigation.issue_keys(self.delivery_comparisons)
        if month is None:
            return issues
        return issues.filter(F.col("current_month") == F.lit(month_argument(month)))

    def investigate(self, month: str | date | None = None) -> "Investigation":
        """All issues, or the one of ``month``; one lazy plan per result."""
        return Investigation(self, self.issue_keys(month))

    def investigate_worst(self) -> "Investigation":
        worst = self.delivery_comparisons.filter("is_delivery_issue")
        worst = worst.orderBy(*detection.worst_first()).limit(1)
        return Investigation(self, investigation.issue_keys(worst))

    def detected(self) -> "Analysis":
        """This analysis with detection done: its few rows are written and read back.

        For consumers that need the issues more than once, each of which would
        otherwise repeat the detection over all orders.
        """
        frozen = copy.copy(self)
        frozen.__dict__.pop("delivery_issues", None)
        frozen.delivery_comparisons = materialise(self.delivery_comparisons, "comparisons")
        return frozen

    def investigate_shared(
        self, month: str | date | None = None, levels: Iterable[str] = tuple(investigation.LEVELS)
    ) -> "Investigation":
        """Like :meth:`investigate`, for consumers of several results.

        Detection is written to the shared folder first, then the measures of ``levels``
        (see ``investigation.drill_down``), for which the orders are read once.  The results
        are made of those measures, a few rows per issue and member.
        """
        frozen, levels = self.detected(), list(levels)
        issues = frozen.issue_keys(month)
        source = Investigation(frozen, issues)
        orders = source.reviewed_orders
        if "seller" in levels:
            orders = source.attributed_reviewed_orders
        if "state" in levels:
            orders = investigation.with_state(orders, self.customers)
        measured = investigation.drill_down(orders, levels)
        return Investigation(frozen, issues, materialise(measured, "drill_down"))


class Investigation:
    """The five results for a table of issues.

    ``measured`` holds the measures of the levels that the results need; without them each
    result looks up what it needs and aggregates the orders itself.
    """

    def __init__(
        self, analysis: Analysis, issues: DataFrame, measured: DataFrame | None = None
    ) -> None:
        self.analysis = analysis
        self.issues = issues
        self._measured = measured

    @cached_property
    def orders(self) -> DataFrame:
        a = self.analysis
        return investigation.investigation_orders(a.timed_orders, self.issues, a.settings)

    def _carry(self, column: str) -> bool:
        """Stored orders bring looked-up columns along."""
        return column in self.orders.columns

    def _with_review_score(self, orders: DataFrame) -> DataFrame:
        if self._carry("average_review_score"):
            return orders
        return facts.with_reviews(orders, self.analysis.reviews)

    @cached_property
    def reviewed_orders(self) -> DataFrame:
        return self._with_review_score(self.orders)

    @cached_property
    def placed_orders(self) -> DataFrame:
        if self._carry("customer_state"):
            return self.orders
        return investigation.with_state(self.orders, self.analysis.customers)

    @cached_property
    def attributed_orders(self) -> DataFrame:
        if self._carry("single_seller_id"):
            return self.orders
        return investigation.with_single_seller(self.orders, self.analysis.order_items)

    @cached_property
    def attributed_reviewed_orders(self) -> DataFrame:
        return self._with_review_score(self.attributed_orders)

    @cached_property
    def periods(self) -> DataFrame:
        if self._measured is not None:
            return investigation.periods_of(self._measured)
        return investigation.issue_periods(self.reviewed_orders)

    @cached_property
    def impact(self) -> DataFrame:
        if self._measured is not None:
            return investigation.impact_of(self._measured)
        return investigation.issue_impact(self.orders)

    @cached_property
    def states(self) -> DataFrame:
        settings = self.analysis.settings
        if self._measured is not None:
            return investigation.states_of(self._measured, settings)
        return investigation.issue_states(self.placed_orders, settings)

    @cached_property
    def coverage(self) -> DataFrame:
        if self._measured is not None:
            return investigation.coverage_of(self._measured)
        return investigation.issue_seller_coverage(self.attributed_orders)

    @cached_property
    def sellers(self) -> DataFrame:
        sellers, settings = self.analysis.sellers, self.analysis.settings
        if self._measured is not None:
            return investigation.sellers_of(self._measured, sellers, settings)
        return investigation.issue_sellers(self.attributed_reviewed_orders, sellers, settings)

    def results(self) -> dict[str, DataFrame]:
        return {
            "periods": self.periods,
            "impact": self.impact,
            "states": self.states,
            "coverage": self.coverage,
            "sellers": self.sellers,
        }
