"""The layers over the driver tables, built lazily: raw feed -> silver -> gold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flow, inequality, specialization, stock, survey
from ..sources import feeds, landing
from ..sources.scratch import scratch_path
from . import silver

_LANDED: dict[tuple[str, str], str] = {}  # folders written by this session


class Lake:
    """Lazy DataFrames of every layer. Nothing runs until a result is asked for.

    Gold facts are additive, so a question can ask for the fact at just the keys it
    needs; the answer is the same as summing the full table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.rules = feeds.rules()

    @cached_property
    def flow_raw(self) -> DataFrame:
        return feeds.flow_raw(self.spark, self.sf_dir)

    @cached_property
    def flow_events(self) -> DataFrame:
        return feeds.flow_events(self.spark, self.sf_dir)

    def landed_flow(self) -> str:
        """The whole flow feed as a landing of files, one folder for each kind and period; written once a session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _LANDED:
            path = scratch_path(self.spark, "caged")
            landing.land(self.spark, self.flow_events, path, finish=feeds.flow_text)
            _LANDED[key] = path
        return _LANDED[key]

    @cached_property
    def stock_raw(self) -> DataFrame:
        return feeds.stock_raw(self.spark, self.sf_dir)

    @cached_property
    def survey_raw(self) -> DataFrame:
        return feeds.survey_raw(self.spark, self.sf_dir)

    @cached_property
    def areas(self) -> DataFrame:
        return feeds.areas(self.spark, self.sf_dir)

    @cached_property
    def codes(self) -> DataFrame:
        return feeds.codes(self.spark)

    @cached_property
    def classes(self) -> DataFrame:
        return feeds.classes(self.spark)

    @cached_property
    def sizes(self) -> DataFrame:
        return feeds.firm_sizes(self.spark)

    @cached_property
    def deflators(self) -> DataFrame:
        return feeds.deflators(self.spark)

    @cached_property
    def flow_silver(self) -> DataFrame:
        return silver.flow_silver(self.flow_raw, self.rules)

    @cached_property
    def stock_silver(self) -> DataFrame:
        return silver.stock_silver(self.stock_raw, self.rules, self.classes, self.sizes)

    @cached_property
    def stock_plain(self) -> DataFrame:
        """The same contracts without the section and size lookups, which add no rows and drop none."""
        return silver.stock_without_lookups(self.stock_raw, self.rules)

    @cached_property
    def survey_silver(self) -> DataFrame:
        return silver.survey_silver(self.survey_raw, self.rules)

    def flow(self, *keys: str) -> DataFrame:
        return flow.flow_by(self.flow_silver, self.areas, self.codes, keys or flow.FLOW_KEYS, self.rules.wages)

    def flow_occupations(self, *keys: str) -> DataFrame:
        return flow.flow_by(self.flow_silver, self.areas, self.codes, keys or flow.OCCUPATION_KEYS)

    def median_values(self) -> DataFrame:
        return flow.admission_values(self.flow_silver, self.areas, self.codes)

    def medians(self, collapsed: Sequence[str] = (), **members: str) -> DataFrame:
        """The cube of medians; ``collapsed`` keys only as totals, ``members`` only at the given value."""
        values = self.median_values()
        for key, member in members.items():
            values = values.where(F.col(key) == member)
        return flow.median_cube(values, collapsed=collapsed, kept=tuple(members))

    def stock(self, *keys: str) -> DataFrame:
        keys = keys or stock.STOCK_KEYS
        looked_up = {"cnae_secao", "cnae_secao_descricao", "porte_oficial"} & set(keys)
        source = self.stock_silver if looked_up else self.stock_plain
        return stock.stock_by(source, self.areas, self.codes, keys, wages=self.rules.wages)

    def stock_occupations(self, *keys: str) -> DataFrame:
        return stock.stock_by(
            self.stock_plain, self.areas, self.codes, keys or stock.OCCUPATION_KEYS, stock.OCCUPATION_MEASURES
        )

    def inequality(self) -> DataFrame:
        return inequality.inequality_turnover(self.stock_plain, self.areas, self.rules.region)

    def regional_stock(self) -> DataFrame:
        return stock.regional_stock(silver.wide_region(self.stock_raw, self.rules), self.classes)

    def quotients(self) -> DataFrame:
        return specialization.location_quotient(self.regional_stock(), self.areas, self.codes, self.rules.region)

    def components(self, *keys: str) -> DataFrame:
        return survey.weighted_components(self.survey_silver, self.deflators, keys or survey.COMPONENT_KEYS)

    def rates(self) -> DataFrame:
        return survey.survey_rates(self.components(), self.rules.region)

    def positions(self) -> DataFrame:
        return survey.weighted_by_category(self.survey_silver, self.rules.region)
