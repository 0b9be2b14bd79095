"""Data quality: profiles, rules, coverage and the gates built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from parcella.operators.quantiles import group_quantiles
from parcella.operators.stats import rank_stability, top_ranked
from parcella.sources.staging import staged

CODE = "code_commune"

# Thresholds of the gates.
GOLD_MIN_ROWS = 15_000
TAU_ABOVE = 0.8
STABILITY_TOP = 25


class CriticalRuleViolation(RuntimeError):
    """At least one critical check failed: the run must stop."""


@dataclass(frozen=True)
class Rule:
    """An expectation; ``violation`` is the SQL condition of a row that breaks it."""

    name: str
    violation: str
    critical: bool = False


def has_length(column: str, n: int, critical: bool = True) -> Rule:
    return Rule(f"{column} has {n} characters", f"length({column}) <> {n}", critical)


def is_between(column: str, low: float, high: float, critical: bool = True) -> Rule:
    return Rule(
        f"{column} in [{low}, {high}]", f"{column} < {low} OR {column} > {high}", critical
    )


def is_present(*columns: str, critical: bool = True) -> Rule:
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    return Rule(f"{' and '.join(columns)} present", missing, critical)


def at_least(column: str, low: float, critical: bool = True) -> Rule:
    return Rule(f"{column} >= {low}", f"{column} < {low}", critical)


def above(column: str, low: float, critical: bool = True) -> Rule:
    return Rule(f"{column} > {low}", f"{column} <= {low}", critical)


def at_most(column: str, high: float, critical: bool = True) -> Rule:
    return Rule(f"{column} <= {high}", f"{column} > {high}", critical)


def is_one_of(column: str, values: Sequence[str], critical: bool = True) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"{column} among {listed}", f"{column} NOT IN ({listed})", critical)


_COMMUNE = has_length(CODE, 5)
_ZONE = has_length("code_iris", 9)

# Rules and bounds of each table.
RULES: dict[str, list[Rule]] = {
    "ventes": [
        is_between("prix_m2", 100, 50_000),
        is_between("surface_bati", 9, 1_000),
        is_present("longitude", "latitude"),
        _COMMUNE,
        above("valeur_fonciere", 0, critical=False),
        is_one_of("type_local", ("Maison", "Appartement"), critical=False),
    ],
    "commune_geom": [
        _COMMUNE,
        is_present("geom"),
        Rule(
            "surface_km2 positive",
            "surface_km2 IS NULL OR isnan(surface_km2) OR surface_km2 <= 0",
            True,
        ),
    ],
    "iris_geom": [
        _ZONE,
        _COMMUNE,
        is_present("geom"),
        is_one_of("type_iris", ("H", "A", "D", "Z")),
        at_least("nb_iris_commune", 1),
    ],
    "iris_prix": [
        _ZONE,
        _COMMUNE,
        is_between("prix_m2_median", 100, 50_000),
        above("nb_transactions", 0),
        Rule("vintage span consistent", "annee_min > annee_max OR nb_millesimes < 1", True),
    ],
    "commune_transport": [
        at_least("nb_arrets", 0),
        at_least("densite_arrets_km2", 0),
        Rule(
            "density matches count and area",
            "surface_km2 > 0 AND densite_arrets_km2 IS NOT NULL "
            "AND abs(densite_arrets_km2 - nb_arrets / surface_km2) > 1e-6",
        ),
    ],
    "revenus": [
        _COMMUNE,
        is_present("revenu_median"),
        is_between("revenu_median", 5_000, 80_000),
        Rule("first quartile under median", "revenu_q1 > revenu_median"),
    ],
    "risques": [
        _COMMUNE,
        at_least("nb_arretes_catnat", 0),
        Rule("floods within total", "nb_arretes_inondation > nb_arretes_catnat", True),
    ],
    "equipements": [
        _COMMUNE,
        at_least("nb_services_sante", 0),
        at_least("nb_loisirs_culture", 0),
    ],
    "securite": [
        _COMMUNE,
        at_least("taux_delinquance_global", 0),
        at_most("taux_delinquance_global", 2_000),
        at_least("nb_indicateurs_diffuses", 1),
    ],
    "emploi": [
        _COMMUNE,
        is_between("taux_chomage", 0, 50),
        is_between("taux_couverture_emploi", 0, 50),
        Rule("active population present", "pop_active IS NULL OR pop_active <= 0", True),
    ],
    "climat": [
        _COMMUNE,
        is_between("ensoleillement_h_an", 500, 3_200),
        is_between("jours_ensoleilles", 60, 500),
        Rule(
            "sunny days match sunshine hours",
            "ensoleillement_h_an NOT BETWEEN jours_ensoleilles AND jours_ensoleilles * 16",
            True,
        ),
        is_between("temperature_moy_annuelle", -5, 25, critical=False),
        at_most("dist_station_km", 150, critical=False),
    ],
    "tourisme": [
        _COMMUNE,
        is_between("part_residences_secondaires", 0, 1),
        above("nb_logements", 0),
    ],
    "proximite_metropole": [
        _COMMUNE,
        above("dist_metropole_km", 0),
        at_most("dist_metropole_km", 500),
        is_present("nom_metropole"),
    ],
    "dpe": [is_one_of("etiquette_dpe", tuple("ABCDEFG")), _COMMUNE],
    "avis": [
        _COMMUNE,
        Rule("date_avis from 2005 on", "date_avis < DATE '2005-01-01'", True),
        is_between("note_moyenne", 0, 10),
    ],
    "avis_segments": [
        _COMMUNE,
        is_between("sentiment", -1, 1),
        is_one_of("polarity_field", ("positif", "negatif")),
        Rule("segment text long enough", "length(trim(text)) < 15"),
    ],
}

# The outline pack exists for callers; the silver gate does not apply it.
GATED = tuple(name for name in RULES if name != "commune_geom")


def validate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One report row per rule, all rules evaluated in a single scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.expr(rule.violation)).alias(f"_r{i}") for i, rule in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(rule.name).alias("regle"),
            F.col(f"_r{i}").alias("violations"),
            F.coalesce(
                F.round(F.try_divide(100.0 * F.col(f"_r{i}"), F.col("_total")), 3), F.lit(0.0)
            ).alias("pct"),
            F.lit(rule.critical).alias("critique"),
            F.when(F.col(f"_r{i}") == 0, "OK").otherwise("KO").alias("statut"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def profile_table(
    df: DataFrame, numeric: Sequence[str] = (), *, exact: bool = True
) -> DataFrame:
    """One row per column: type, share missing, distinct values, min/median/max.

    Columns are unpivoted once and counted by (column, value) with map-side
    combining, so all cardinalities come from one shuffle. ``exact=False``
    swaps that for sketches and a single pass.
    """
    names = df.columns
    kinds = dict(df.dtypes)
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(n).alias("colonne"),
                F.lit(kinds[n]).alias("type"),
                F.col(n).cast("string").alias("v"),
            )
            for i, n in enumerate(names)
        ]
    )
    head = ["position", "colonne", "type"]
    long = df.select(F.inline(columns))
    if exact:
        counted = long.groupBy(*head, "v").agg(F.count(F.lit(1)).alias("_n"))
        shape = counted.groupBy(*head).agg(
            F.sum("_n").alias("_total"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("_n"))), F.lit(0)).alias("_null"),
            F.count("v").alias("cardinalite"),
        )
    else:
        shape = long.groupBy(*head).agg(
            F.count(F.lit(1)).alias("_total"),
            F.count_if(F.col("v").isNull()).alias("_null"),
            F.approx_count_distinct("v").alias("cardinalite"),
        )
    report = shape.select(
        *head,
        F.round(F.col("_null") * 100.0 / F.col("_total"), 2).alias("pct_manquant"),
        "cardinalite",
    )
    measured = [n for n in numeric if isinstance(df.schema[n].dataType, NumericType)]
    if measured:
        values = df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(n).alias("_column"), F.col(n).cast("double").alias("_v"))
                        for n in measured
                    ]
                )
            )
        )
        spread = group_quantiles(
            values,
            ["_column"],
            "_v",
            {"mediane": 0.5},
            facts={"min": (F.min("_v"), F.min), "max": (F.max("_v"), F.max)},
            method="ranked" if exact else "approx",
        )
        report = report.join(spread, F.col("colonne") == F.col("_column"), "left")
        return report.select(
            *head, "pct_manquant", "cardinalite", F.col("min"), F.col("mediane"), F.col("max")
        )
    return report


def coverage(
    sources: Mapping[str, DataFrame | None],
    reference: DataFrame,
    key: str = CODE,
    thresholds: Mapping[str, tuple[float, str]] | None = None,
) -> DataFrame:
    """Distinct keys per source and their share of the reference.

    A source given as None was not produced; one under its threshold carries
    the threshold's note as an alert.
    """
    thresholds = thresholds or {}
    total = reference.agg(F.count_distinct(key).alias("_reference"))
    parts = []
    for label, frame in sources.items():
        if frame is None:
            part = total.select(
                F.lit(0).cast("long").alias("communes"), F.lit(True).alias("_absent")
            )
        else:
            part = frame.agg(F.count_distinct(key).alias("communes")).withColumn(
                "_absent", F.lit(False)
            )
        limit, note = thresholds.get(label, (None, ""))
        parts.append(
            part.withColumn("source", F.lit(label))
            .withColumn("_limit", F.lit(limit).cast("double"))
            .withColumn("_note", F.lit(note))
        )
    merged = reduce(DataFrame.unionByName, parts)
    rate = F.coalesce(
        F.round(F.try_divide(F.col("communes") * 100.0, F.col("_reference")), 1), F.lit(0.0)
    )
    counted = merged.withColumn(
        "_reference", total.select("_reference").scalar()
    ).withColumn("taux_pct", rate)
    return counted.select(
        "source",
        "communes",
        "taux_pct",
        F.when(F.col("_absent"), "table absente")
        .when(
            F.col("taux_pct") < F.col("_limit"),
            F.when(F.col("_note") == "", "couverture faible").otherwise(F.col("_note")),
        )
        .otherwise("")
        .alias("alerte"),
    )


def match_rate(left: DataFrame, right: DataFrame, key: str = CODE) -> DataFrame:
    """Distinct keys of ``left``, how many ``right`` knows, how many are orphans."""
    keys = left.select(key).where(F.col(key).isNotNull()).distinct()
    known = right.select(F.col(key).alias("_known")).distinct()
    joined = keys.join(known, F.col(key) == F.col("_known"), "left")
    return joined.agg(
        F.count(F.lit(1)).alias("cles_left"), F.count("_known").alias("appariees")
    ).select(
        "cles_left",
        "appariees",
        (F.col("cles_left") - F.col("appariees")).alias("orphelines"),
        F.coalesce(
            F.round(F.try_divide(F.col("appariees") * 100.0, F.col("cles_left")), 2), F.lit(0.0)
        ).alias("taux"),
    )


# --- gates -------------------------------------------------------------------


def dq_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every rule of every table at hand, in one report."""
    parts = [
        validate_rules(tables[name], RULES[name]).select(F.lit(name).alias("table"), "*")
        for name in GATED
        if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_checks(scores: DataFrame) -> DataFrame:
    """Volume, missing scores and gaps out of [-1, 1], from one scan."""
    return scores.agg(
        F.count(F.lit(1)).alias("nb_communes_scorees"),
        F.count_if(F.col("score_valeur").isNull()).alias("nb_score_null"),
        F.count_if((F.col("gap") < -1) | (F.col("gap") > 1)).alias("nb_gap_hors_bornes"),
    )


def zone_checks(zones: DataFrame) -> DataFrame:
    """Duplicates, bounds and inheritance of the neighbourhood scores."""
    price, gap = F.col("n_prix_iris"), F.col("gap_iris")
    return zones.agg(
        F.count(F.lit(1)).alias("nb_iris_scores"),
        (F.count(F.lit(1)) - F.count_distinct("code_iris")).alias("nb_code_iris_dupliques"),
        F.count_if(price.isNull() | (price < 0) | (price > 1)).alias("nb_n_prix_hors_bornes"),
        F.count_if((gap < -1) | (gap > 1)).alias("nb_gap_hors_bornes"),
        F.count_if(F.col("score_commune").isNull()).alias("nb_score_commune_null"),
    )


def review_checks(rollup: DataFrame) -> DataFrame:
    """Bounds and flag coherence of the review roll-up."""
    tone = F.col("sentiment_global")
    return rollup.agg(
        F.count(F.lit(1)).alias("nb_communes_avis"),
        F.count_if((tone < -1) | (tone > 1)).alias("nb_sentiment_hors_bornes"),
        F.count_if(F.col("n_avis") <= 0).alias("nb_n_avis_non_positif"),
        F.count_if(F.col("low_data") != (F.col("n_avis") < 10)).alias("nb_low_data_incoherent"),
        F.count_if((F.col("n_avis") > 0) & (F.size("wordcloud") == 0)).alias("nb_wordcloud_vide"),
    )


def _store(report: DataFrame, path: str | None) -> None:
    if path:
        report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _stop_on(failures: list[str]) -> None:
    if failures:
        raise CriticalRuleViolation("; ".join(failures))


SILVER_REPORT = (
    "section string, table string, regle string, nombre long, pct double, critique boolean, statut string"
)


def stored_with_counts(df: DataFrame, name: str, rules: Sequence[Rule]) -> tuple[DataFrame, dict]:
    """The stored keys of ``df``, and its rows and violations, counted while they are written."""
    counts = Observation(name)
    observed = df.observe(
        counts,
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.expr(rule.violation)).alias(f"r{i}") for i, rule in enumerate(rules)],
    )
    return staged(observed.select(CODE), name), counts.get


def silver_report(
    tables: Mapping[str, DataFrame],
    *,
    reference: str = "commune_geom",
    sales: str = "ventes",
    zones: str = "iris_geom",
) -> list[tuple]:
    """Rows of ``SILVER_REPORT`` over every gated table, its keys stored on the way.

    Rules are counted while the keys of a table are written, without a scan of their own, and
    only their columns are read; coverage and the match of sales with zones read the keys. A gated table that is not at
    hand is reported as absent, and without ``reference`` (or zones) there is no coverage
    (or match).
    """
    stored, rows = {}, []
    for name in GATED:
        if name not in tables:
            rows.append(("rules", name, None, None, None, False, "absente"))
            continue
        stored[name], counts = stored_with_counts(tables[name], name, RULES[name])
        for i, rule in enumerate(RULES[name]):
            bad, total = counts[f"r{i}"], counts["total"]
            pct = round(Decimal(100 * bad) / total, 3) if total else 0
            rows.append(("rules", name, rule.name, bad, float(pct), rule.critical, "KO" if bad else "OK"))
    if reference in tables:
        found = coverage(stored, tables[reference])
        for r in found.collect():  # one row a table
            rows.append(("coverage", r["source"], None, r["communes"], r["taux_pct"], False, r["alerte"] or "OK"))
    if sales in stored and zones in stored:
        r = match_rate(stored[sales], stored[zones]).first()
        rows.append(("match", sales, zones, r["orphelines"], r["taux"], False, "OK"))
    return rows


def check_silver(tables: Mapping[str, DataFrame], report_path: str | None = None) -> DataFrame:
    """The silver report, stored before a critical violation stops the run."""
    rows = silver_report(tables)
    report = next(iter(tables.values())).sparkSession.createDataFrame(rows, SILVER_REPORT)
    _store(report, report_path)
    _stop_on([f"{r[1]}: {r[2]}" for r in rows if r[5] and r[6] == "KO"])
    return report


def check_gold(
    scores: DataFrame,
    *,
    previous_top: DataFrame | None = None,
    min_rows: int = GOLD_MIN_ROWS,
    report_path: str | None = None,
) -> dict:
    """Gate on the territory scores; ``previous_top`` holds (code, rang) of the last run."""
    report = gold_checks(scores).first().asDict()
    top = top_ranked(scores, "gap_pondere", [CODE], STABILITY_TOP).select(CODE, "rang")
    report["top"] = [r[0] for r in top.orderBy("rang").collect()]
    failures = []
    if report["nb_communes_scorees"] < min_rows:
        failures.append(f"{report['nb_communes_scorees']} scored communes, {min_rows} expected")
    if report["nb_score_null"]:
        failures.append(f"{report['nb_score_null']} communes without score")
    if report["nb_gap_hors_bornes"]:
        failures.append(f"{report['nb_gap_hors_bornes']} gaps out of [-1, 1]")
    if previous_top is not None:
        tau = rank_stability(previous_top, top, CODE).first()["tau"]
        report["kendall_tau"] = round(tau, 4)
        if tau <= TAU_ABOVE:
            failures.append(f"top {STABILITY_TOP} unstable (tau {tau:.3f})")
    _store(scores.sparkSession.createDataFrame([report]), report_path)
    _stop_on(failures)
    return report


def _check_counts(
    counts: DataFrame, critical: Sequence[str], report_path: str | None, empty: str | None = None
) -> dict:
    report = counts.first().asDict()
    failures = [f"{name} = {report[name]}" for name in critical if report[name]]
    if empty and report[empty] == 0:
        failures.append("empty table")
    _store(counts.sparkSession.createDataFrame([report]), report_path)
    _stop_on(failures)
    return report


def check_zones(zones: DataFrame, report_path: str | None = None) -> dict:
    """Gate on the neighbourhood scores; an empty table is critical."""
    critical = (
        "nb_code_iris_dupliques",
        "nb_n_prix_hors_bornes",
        "nb_gap_hors_bornes",
        "nb_score_commune_null",
    )
    return _check_counts(zone_checks(zones), critical, report_path, "nb_iris_scores")


def check_reviews(rollup: DataFrame, report_path: str | None = None) -> dict:
    """Gate on the review roll-up; partial coverage is normal, empty clouds are only reported."""
    critical = ("nb_sentiment_hors_bornes", "nb_n_avis_non_positif", "nb_low_data_incoherent")
    return _check_counts(review_checks(rollup), critical, report_path)


def missing_share(c: Column | str, is_text: bool) -> Column:
    """Share of rows where a column is NULL, or blank if it is text."""
    value = F.col(c) if isinstance(c, str) else c
    missing = value.isNull() | (F.trim(value) == "") if is_text else value.isNull()
    return F.avg(F.coalesce(missing, F.lit(True)).cast("double"))
