"""Every query by its ID, bound to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from custodia import config
from custodia.fixtures import binding, oracle, oracle_etl, registry_etl
from custodia.plans import addiction, bail_gap, charts, conditions, innocence, marts, plea, reform
from custodia.plans.star import Star

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = binding.AS_OF
LAST_YEAR = date(2020, 8, 2)
LAST_THREE_YEARS = date(2018, 8, 2)
LAST_180_DAYS = date(2021, 2, 3)


def _on_star(report: Callable[[Star], DataFrame], **limits) -> Query:
    return lambda spark, sf_dir: report(binding.star(spark, sf_dir, **limits))


def _reports() -> dict[str, Query]:
    year = dict(since=LAST_YEAR)
    window = dict(since=config.REFORM_WINDOW[0], until=config.REFORM_WINDOW[1])
    plea_years = dict(since=config.PLEA_SINCE)
    return {
        "M1": _on_star(marts.bail_gap_by_zip),
        "M2": _on_star(marts.innocence_by_jurisdiction, home=False),
        "Q01": _on_star(lambda s: innocence.by_jurisdiction(s, AS_OF), home=False, **year),
        "Q02": _on_star(lambda s: innocence.by_charge_category(s, AS_OF), **year),
        "Q03": _on_star(lambda s: innocence.by_age(s, AS_OF), home=False, **year),
        "Q04": _on_star(plea.disposition_by_time_held, **plea_years),
        "Q05": _on_star(plea.innocence_tax, home=False, **plea_years),
        "Q06": _on_star(plea.poverty_premium, **plea_years),
        "Q07": _on_star(lambda s: addiction.scale_by_charge(s, AS_OF), since=LAST_THREE_YEARS),
        "Q08": _on_star(lambda s: addiction.by_zip(s, AS_OF), since=LAST_THREE_YEARS),
        "Q09": _on_star(addiction.repeat_cycle, home=False),
        "Q10": _on_star(bail_gap.by_zip, since=config.BAIL_GAP_SINCE),
        "Q11": _on_star(lambda s: bail_gap.fixed_bail(marts.bail_gap_by_zip(s))),
        "Q12": _on_star(lambda s: bail_gap.against_eviction(s, marts.bail_gap_by_zip(s))),
        "Q13": _on_star(reform.before_and_after, **window),
        "Q14": _on_star(reform.monthly, home=False, **window),
        "Q15": _on_star(reform.by_income_tier, **window),
        "Q16": _on_star(conditions.snapshot, home=False),
        "Q17": _on_star(conditions.in_custody, home=False),
        "Q18": _on_star(
            lambda s: conditions.crowding_trend(s, AS_OF), home=False, since=LAST_180_DAYS
        ),
        "Q19": _on_star(conditions.solitary, home=False),
        "Q20": _on_star(conditions.taxonomy_use, home=False),
    }


def _charts() -> dict[str, Query]:
    year = dict(since=LAST_YEAR)
    window = dict(since=config.REFORM_WINDOW[0], until=config.REFORM_WINDOW[1])
    return {
        "C01": _on_star(
            lambda s: charts.innocence_bar(marts.innocence_by_jurisdiction(s)), home=False
        ),
        "C02": _on_star(lambda s: charts.bail_wall(s, AS_OF), home=False, **year),
        "C03": _on_star(lambda s: charts.charge_mix(s, AS_OF), **year),
        "C04": _on_star(lambda s: charts.bail_gap_map(marts.bail_gap_by_zip(s))),
        "C05": _on_star(lambda s: charts.fixed_bail_bars(marts.bail_gap_by_zip(s))),
        "C06": _on_star(charts.resolution_flow, home=False),
        "C07": _on_star(charts.plea_curve, since=config.PLEA_SINCE),
        "C08": _on_star(charts.addiction_by_year, home=False, since=config.PLEA_SINCE),
        "C09": _on_star(charts.repeat_bookings, home=False),
        "C10": _on_star(lambda s: charts.possession_by_income(s, AS_OF), since=LAST_THREE_YEARS),
        "C11": _on_star(
            lambda s: charts.crowding_timeline(s, AS_OF), home=False, since=LAST_180_DAYS
        ),
        "C12": lambda spark, d: charts.deaths_timeline(binding.deaths(spark, d)),
        "C13": _on_star(charts.force_against_crowding, home=False),
        "C14": _on_star(charts.reform_cards, **window),
        "C15": _on_star(charts.reform_by_income, **window),
        "C16": _on_star(charts.reform_monthly_rates, home=False, **window),
        "C17": _on_star(lambda s: charts.dashboard_row(s, year=2020)),
    }


def queries() -> dict[str, Query]:
    return {**registry_etl.queries(), **_reports(), **_charts()}


def oracle_sql() -> dict[str, str]:
    return {**oracle_etl.checks(), **oracle.star_checks()}
