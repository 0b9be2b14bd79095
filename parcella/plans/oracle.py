"""ANSI SQL twins of the registered queries, for an independent engine."""

from __future__ import annotations

from parcella.functions.geo import AUTHALIC_KM, authalic_sine
from parcella.functions.lexicon import GENERIC_WORDS, STOP_WORDS
from parcella.functions.text import theme_pattern
from parcella.operators.quality import RULES
from parcella.operators.sales import RELIABLE_FROM
from parcella.operators.scores import DIMENSIONS, WEIGHTS
from parcella.plans.registry import SOURCE, VOCABULARY
from parcella.plans.views import SHAPE, VIEWS, with_clause

# Shared intermediate results, on top of the input views.
STEPS = dict(VIEWS)
ORACLE: dict[str, str] = {}

STEPS |= {
    "line": """
        SELECT id_mutation, nature_mutation, type_local,
               TRY_CAST(valeur_fonciere AS DOUBLE) AS valeur_fonciere,
               TRY_CAST(surface_reelle_bati AS DOUBLE) AS surface_bati,
               code_commune, nom_commune, code_departement, longitude, latitude, annee
        FROM sale_raw
        WHERE nature_mutation = 'Vente' AND type_local IN ('Maison', 'Appartement')
          AND surface_reelle_bati > 0 AND valeur_fonciere > 0""",
    "sale": """
        SELECT id_mutation, min(type_local) AS type_local,
               min(valeur_fonciere) AS valeur_fonciere, sum(surface_bati) AS surface_bati,
               min(code_commune) AS code_commune, min(nom_commune) AS nom_commune,
               min(code_departement) AS code_departement,
               min(longitude) AS longitude, min(latitude) AS latitude,
               min(valeur_fonciere) / nullif(sum(surface_bati), 0) AS prix_m2,
               min(annee) AS annee
        FROM line GROUP BY id_mutation
        HAVING count(DISTINCT valeur_fonciere) = 1 AND count(DISTINCT type_local) = 1""",
    "bounded": """
        SELECT * FROM sale
        WHERE surface_bati BETWEEN 9 AND 1000 AND longitude IS NOT NULL
          AND latitude IS NOT NULL AND prix_m2 BETWEEN 100 AND 50000""",
    "clipped": """
        SELECT b.* FROM bounded AS b JOIN (
            SELECT code_departement, type_local, quantile_cont(prix_m2, 0.01) AS lo,
                   quantile_cont(prix_m2, 0.99) AS hi
            FROM bounded GROUP BY code_departement, type_local) AS q
        USING (code_departement, type_local)
        WHERE prix_m2 BETWEEN lo AND hi""",
    "price": """
        SELECT code_commune, min(nom_commune) AS nom_commune,
               min(code_departement) AS code_departement, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median,
               quantile_cont(prix_m2, 0.25) AS prix_m2_p25,
               quantile_cont(prix_m2, 0.75) AS prix_m2_p75,
               avg(prix_m2) AS prix_m2_moyen, count(*) >= 5 AS fiable
        FROM clipped GROUP BY code_commune""",
    "price_type": """
        SELECT code_commune, type_local, min(nom_commune) AS nom_commune,
               min(code_departement) AS code_departement, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median, count(*) >= 5 AS fiable
        FROM clipped GROUP BY code_commune, type_local""",
    "price_dept": """
        SELECT code_departement, type_local, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median, count(*) >= 5 AS fiable,
               grouping(type_local) = 1 AS tous_types
        FROM clipped GROUP BY GROUPING SETS ((code_departement), (code_departement, type_local))""",
    "vintage": """
        SELECT b.* FROM bounded AS b JOIN (
            SELECT annee, code_departement, type_local, quantile_cont(prix_m2, 0.01) AS lo,
                   quantile_cont(prix_m2, 0.99) AS hi
            FROM bounded GROUP BY annee, code_departement, type_local) AS q
        USING (annee, code_departement, type_local)
        WHERE prix_m2 BETWEEN lo AND hi""",
    "vintage_price": """
        SELECT annee, code_commune, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median
        FROM vintage GROUP BY annee, code_commune""",
    "mutation": """
        SELECT id_mutation, min(date_mutation) AS date_mutation,
               min(nature_mutation) AS nature_mutation, min(valeur_fonciere) AS valeur_fonciere,
               min(code_commune) AS code_commune, min(nom_commune) AS nom_commune,
               min(code_departement) AS code_departement,
               min(longitude) AS longitude, min(latitude) AS latitude,
               count(*) AS nb_locaux_batis,
               count(*) FILTER (type_local = 'Maison') AS nb_maisons,
               count(*) FILTER (type_local = 'Appartement') AS nb_appartements,
               sum(surface_reelle_bati) AS surface_bati_totale, min(type_local) AS type_local
        FROM sale_raw WHERE nature_mutation = 'Vente' AND valeur_fonciere > 0
        GROUP BY id_mutation""",
    "priced": """
        SELECT *, valeur_fonciere / surface_bati_totale AS prix_m2
        FROM mutation WHERE nb_locaux_batis = 1 AND surface_bati_totale > 0""",
    "single": """
        SELECT p.* FROM priced AS p JOIN (
            SELECT code_departement, type_local, quantile_cont(prix_m2, 0.01) AS lo,
                   quantile_cont(prix_m2, 0.99) AS hi
            FROM priced GROUP BY code_departement, type_local) AS q
        USING (code_departement, type_local) WHERE prix_m2 BETWEEN lo AND hi""",
    "single_approx": """
        SELECT p.* FROM priced AS p JOIN (
            SELECT code_departement, type_local, quantile_disc(prix_m2, 0.01) AS lo,
                   quantile_disc(prix_m2, 0.99) AS hi
            FROM priced GROUP BY code_departement, type_local) AS q
        USING (code_departement, type_local) WHERE prix_m2 BETWEEN lo AND hi""",
}


def half_up(x: str, digits: int = 6) -> str:
    """Round half up on the decimal digits of a double, as Spark's ``round`` does."""
    exact = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


def rounded(*names: str, digits: int = 6, prefix: str = "") -> str:
    """Select list of rounded doubles under their own names."""
    return ", ".join(f"{half_up(prefix + n, digits)} AS {n}" for n in names)


_PLACE = "code_commune, nom_commune, code_departement"
_SALE = (
    f"id_mutation, type_local, {_PLACE}, "
    + rounded("valeur_fonciere", "surface_bati", "longitude", "latitude", "prix_m2")
)


def _spread(source: str, keys: str, quantile: str = "quantile_cont") -> str:
    return f"""
        SELECT {keys}, count(*) AS nb_transactions,
               {half_up(quantile + "(prix_m2, 0.5)")} AS prix_m2_median,
               {half_up(quantile + "(prix_m2, 0.25)")} AS prix_m2_p25,
               {half_up(quantile + "(prix_m2, 0.75)")} AS prix_m2_p75,
               {half_up("avg(prix_m2)", 2)} AS prix_m2_moyen,
               {half_up("min(prix_m2)")} AS prix_m2_min,
               {half_up("max(prix_m2)")} AS prix_m2_max,
               count(*) >= 5 AS fiable
        FROM {source} GROUP BY {keys}"""


_RAW = (
    "id_mutation, numero_disposition, nature_mutation, type_local, code_commune, nom_commune, "
    "code_departement, date_mutation, annee, "
    + rounded("valeur_fonciere", "surface_reelle_bati", "longitude", "latitude")
)
_MUTATION = (
    "id_mutation, date_mutation, nature_mutation, code_commune, nom_commune, code_departement, "
    "nb_locaux_batis, nb_maisons, nb_appartements, type_local, "
    + rounded("valeur_fonciere", "longitude", "latitude", "surface_bati_totale")
)

ORACLE |= {
    "sale_lines": f"""
        SELECT id_mutation, nature_mutation, type_local, {_PLACE}, annee,
               {rounded("valeur_fonciere", "surface_bati", "longitude", "latitude")} FROM line""",
    "dedup_sales": f"SELECT {_SALE} FROM sale",
    "bounded_sales": f"SELECT {_SALE} FROM bounded",
    "clip_sales": f"SELECT {_SALE} FROM clipped",
    "commune_agg": f"""
        SELECT {_PLACE}, nb_transactions, fiable,
               {rounded("prix_m2_median", "prix_m2_p25", "prix_m2_p75", "prix_m2_moyen")}
        FROM price""",
    "commune_agg_type": f"""
        SELECT type_local, {_PLACE}, nb_transactions, fiable, {rounded("prix_m2_median")}
        FROM price_type""",
    "dept_agg": f"""
        SELECT code_departement, type_local, nb_transactions, fiable, tous_types,
               {rounded("prix_m2_median")} FROM price_dept""",
    "vintage_prices": f"""
        SELECT annee, code_commune, nb_transactions, {rounded("prix_m2_median")}
        FROM vintage_price""",
    "vintage_points": f"""
        SELECT annee, id_mutation, code_commune, type_local,
               {rounded("longitude", "latitude", "prix_m2")} FROM vintage""",
    "bronze_typed": f"SELECT {_RAW} FROM sale_raw",
    "quality_filter": f"""
        SELECT {_RAW} FROM sale_raw
        WHERE nature_mutation IN ('Vente') AND valeur_fonciere IS NOT NULL
          AND valeur_fonciere > 0""",
    "mutations": f"SELECT {_MUTATION} FROM mutation",
    "single_dwelling_price": f"SELECT {_MUTATION}, {rounded('prix_m2')} FROM single",
    "single_dwelling_price_approx": f"SELECT {_MUTATION}, {rounded('prix_m2')} FROM single_approx",
    "agg_commune_type_stats": _spread(
        "single", "code_departement, code_commune, nom_commune, type_local"
    ),
    "agg_dept_type_stats": _spread("single", "code_departement, type_local"),
    "agg_dept_type_stats_approx": _spread(
        "single", "code_departement, type_local", "quantile_disc"
    ),
    "transactions": f"""
        SELECT id_mutation, date_mutation, type_local, {_PLACE},
               {rounded("valeur_fonciere", "longitude", "latitude")},
               {half_up("surface_bati_totale")} AS surface_bati,
               {rounded("prix_m2", digits=2)}
        FROM single""",
}


# --- territories and indicators ----------------------------------------------

_AREA = (
    f"{AUTHALIC_KM**2!r} * radians(max_x - min_x) "
    f"* ({authalic_sine('max_y', 'e0')} - {authalic_sine('min_y', 'e0')})"
)


def _arc(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle km between two places, haversine form."""
    half = (
        f"power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"2 * 6371 * asin(sqrt(least(1, {half})))"


STEPS |= {
    "ref": "SELECT code_commune, nom_commune, min_x, max_x, min_y, max_y FROM box",
    "income": """
        SELECT code AS code_commune, label AS nom_commune,
               TRY_CAST(median_text AS DOUBLE) AS revenu_median,
               TRY_CAST(q1_text AS DOUBLE) AS revenu_q1
        FROM income_raw JOIN ref ON code = code_commune
        WHERE TRY_CAST(median_text AS DOUBLE) BETWEEN 5000 AND 80000""",
    "risk": """
        SELECT code_commune, count(*) AS nb_arretes_catnat,
               count(*) FILTER (lower(lib_risque_jo) LIKE '%inondation%'
                                OR lower(lib_risque_jo) LIKE '%coulée%') AS nb_arretes_inondation
        FROM risk_raw WHERE code_commune IN (SELECT code_commune FROM ref)
        GROUP BY code_commune""",
    "housing": """
        SELECT "COM" AS code_commune, sum(TRY_CAST("P21_LOG" AS DOUBLE)) AS nb_logements,
               sum(TRY_CAST("P21_RSECOCC" AS DOUBLE))
                   / nullif(sum(TRY_CAST("P21_LOG" AS DOUBLE)), 0) AS part_residences_secondaires
        FROM housing_raw WHERE "COM" IN (SELECT code_commune FROM ref)
        GROUP BY "COM"
        HAVING sum(TRY_CAST("P21_LOG" AS DOUBLE)) > 0""",
    "rate": """
        SELECT "CODGEO_2025" AS code_commune,
               sum(TRY_CAST(replace(taux_pour_mille, ',', '.') AS DOUBLE))
                   AS taux_delinquance_global,
               count(*) AS nb_indicateurs_diffuses,
               max(CAST(insee_pop AS INTEGER)) AS insee_pop
        FROM rate_raw
        WHERE est_diffuse = 'diff' AND "CODGEO_2025" IN (SELECT code_commune FROM ref)
          AND CAST(annee AS INTEGER) = (SELECT max(CAST(annee AS INTEGER)) FROM rate_raw)
        GROUP BY "CODGEO_2025"
        HAVING sum(TRY_CAST(replace(taux_pour_mille, ',', '.') AS DOUBLE)) BETWEEN 0 AND 2000""",
    "facility": """
        SELECT "GEO" AS code_commune,
               coalesce(sum(CAST("OBS_VALUE" AS DOUBLE))
                   FILTER ("FACILITY_DOM" IN ('A', 'B', 'C', 'D')), 0) AS nb_services_sante,
               coalesce(sum(CAST("OBS_VALUE" AS DOUBLE))
                   FILTER ("FACILITY_DOM" = 'F'), 0) AS nb_loisirs_culture
        FROM facility_raw
        WHERE "GEO_OBJECT" = 'COM' AND "GEO" IN (SELECT code_commune FROM ref)
        GROUP BY "GEO" """,
    "job": f"""
        SELECT * FROM (
            SELECT "CODGEO" AS code_commune,
                   CAST("P21_ACT1564" AS INTEGER) AS pop_active,
                   {half_up('CAST("P21_CHOM1564" AS DOUBLE) / CAST("P21_ACT1564" AS DOUBLE) * 100', 2)}
                       AS taux_chomage,
                   {half_up('CAST("P21_EMPLT" AS DOUBLE) / CAST("P21_ACT1564" AS DOUBLE)', 3)}
                       AS taux_couverture_emploi
            FROM job_raw WHERE "CODGEO" IN (SELECT code_commune FROM ref)) AS rates
        WHERE taux_chomage BETWEEN 0 AND 50 AND taux_couverture_emploi BETWEEN 0 AND 50""",
    "label": """
        SELECT code_insee_ban AS code_commune, upper(trim(etiquette_dpe)) AS etiquette_dpe
        FROM label_raw
        WHERE upper(trim(etiquette_dpe)) IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')
          AND code_insee_ban IN (SELECT code_commune FROM ref)""",
    "centre": "SELECT code_commune, (min_x + max_x) / 2 AS lon, (min_y + max_y) / 2 AS lat FROM ref",
    "climate": f"""
        SELECT * FROM (
            SELECT c.code_commune, s.ensoleillement_h_an,
                   CAST(round(s.ensoleillement_h_an / 6.5e0) AS INTEGER) AS jours_ensoleilles,
                   s.temperature_moy_annuelle,
                   {_arc("c.lat", "c.lon", "s.lat", "s.lon")} AS dist_station_km,
                   row_number() OVER (PARTITION BY c.code_commune ORDER BY
                       {_arc("c.lat", "c.lon", "s.lat", "s.lon")}, s.num_poste) AS rk
            FROM centre AS c CROSS JOIN station_raw AS s) AS ranked
        WHERE rk = 1 AND dist_station_km <= 150 AND ensoleillement_h_an BETWEEN 500 AND 3200""",
    "city": f"""
        SELECT * FROM (
            SELECT c.code_commune, trim(m.nom_standard) AS nom_metropole,
                   {_arc("c.lat", "c.lon", "m.latitude_centre", "m.longitude_centre")}
                       AS dist_metropole_km,
                   row_number() OVER (PARTITION BY c.code_commune ORDER BY
                       {_arc("c.lat", "c.lon", "m.latitude_centre", "m.longitude_centre")},
                       m.code_insee) AS rk
            FROM centre AS c CROSS JOIN city_raw AS m
            WHERE CAST(m.population AS BIGINT) >= 50000) AS ranked
        WHERE rk = 1 AND dist_metropole_km <= 500""",
    "stop": f"""
        SELECT DISTINCT {half_up("stop_lat", 5)} AS lat, {half_up("stop_lon", 5)} AS lon
        FROM stop_raw
        WHERE {half_up("stop_lon", 5)} BETWEEN -62 AND 56
          AND {half_up("stop_lat", 5)} BETWEEN -22 AND 51.5""",
    "density": f"""
        SELECT code_commune, {_AREA} AS surface_km2, coalesce(n, 0) AS nb_arrets,
               coalesce(n, 0) / ({_AREA}) AS densite_arrets_km2
        FROM ref LEFT JOIN (
            SELECT code_commune AS code, count(*) AS n
            FROM ref JOIN stop
              ON lon > min_x AND lon < max_x AND lat > min_y AND lat < max_y
            GROUP BY code_commune) AS inside ON code = code_commune""",
    "zone": """
        SELECT code_iris, code_commune, nom_commune, nom_iris, type_iris,
               count(*) OVER (PARTITION BY code_commune) AS nb_iris_commune,
               min_x, max_x, min_y, max_y
        FROM zone_box""",
    "assigned": """
        SELECT id_mutation, p.prix_m2, p.annee, min(z.code_iris) AS code_iris,
               min(z.code_commune) AS code_commune
        FROM vintage AS p JOIN zone AS z ON z.code_commune = p.code_commune
         AND (nb_iris_commune = 1 OR (p.longitude BETWEEN min_x AND max_x
                                      AND p.latitude BETWEEN min_y AND max_y))
        GROUP BY id_mutation, p.prix_m2, p.annee""",
    "zone_price": """
        SELECT code_iris, min(code_commune) AS code_commune, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median, count(*) >= 5 AS fiable,
               min(annee) AS annee_min, max(annee) AS annee_max,
               count(DISTINCT annee) AS nb_millesimes
        FROM assigned GROUP BY code_iris""",
}

ORACLE |= {
    "income_clean": f"SELECT code_commune, nom_commune, {rounded('revenu_median', 'revenu_q1')} FROM income",
    "risk_counts": "SELECT * FROM risk",
    "share_of_sums": f"""
        SELECT code_commune, {rounded("nb_logements", "part_residences_secondaires")} FROM housing""",
    "latest_period_rates": f"""
        SELECT code_commune, nb_indicateurs_diffuses, insee_pop,
               {rounded("taux_delinquance_global", digits=9)} FROM rate""",
    "facility_counts": "SELECT * FROM facility",
    "employment_rates": "SELECT * FROM job",
    "label_clean": "SELECT * FROM label",
    "nearest_station": f"""
        SELECT code_commune, jours_ensoleilles,
               {rounded("ensoleillement_h_an", "temperature_moy_annuelle", "dist_station_km", digits=4)}
        FROM climate""",
    "nearest_metropolis": f"""
        SELECT code_commune, nom_metropole, {rounded("dist_metropole_km", digits=4)} FROM city""",
    "stops_per_cell": f"""
        SELECT code_commune, nb_arrets, {rounded("surface_km2", "densite_arrets_km2")} FROM density""",
    "polygon_area": f"""
        SELECT code_commune, nom_commune, {half_up(_AREA)} AS surface_km2 FROM box""",
    "lod_align": "SELECT code_commune, nom_commune FROM ref",
    "outline_features": f"""
        SELECT code_commune,
               '{{"type":"Feature","properties":{{"code_commune":"' || code_commune
               || '","nom_commune":"' || nom_commune || '"}},"geometry":{{"type":"Polygon",'
               || '"coordinates":[[[' || x0 || ',' || y0 || '],[' || x1 || ',' || y0 || '],['
               || x1 || ',' || y1 || '],[' || x0 || ',' || y1 || '],[' || x0 || ',' || y0
               || ']]]}}}}' AS feature
        FROM (SELECT code_commune, nom_commune,
                     CAST({half_up("min_x", 2)} AS VARCHAR) AS x0,
                     CAST({half_up("max_x", 2)} AS VARCHAR) AS x1,
                     CAST({half_up("min_y", 2)} AS VARCHAR) AS y0,
                     CAST({half_up("max_y", 2)} AS VARCHAR) AS y1 FROM ref) AS texts""",
    "siblings_count": """
        SELECT code_iris, code_commune, nom_commune, nom_iris, type_iris, nb_iris_commune
        FROM zone""",
    "assign_points_to_zones": f"""
        SELECT id_mutation, annee, code_iris, code_commune, {rounded("prix_m2")} FROM assigned""",
    "zone_prices": f"""
        SELECT code_iris, code_commune, nb_transactions, fiable, annee_min, annee_max,
               nb_millesimes, {rounded("prix_m2_median")} FROM zone_price""",
}

# --- scores ------------------------------------------------------------------


def _norm(column: str, invert: bool = False) -> str:
    low = f"(SELECT quantile_cont({column}, 0.01) FROM prepared)"
    high = f"(SELECT quantile_cont({column}, 0.99) FROM prepared)"
    share = f"((greatest({low}, least({high}, {column})) - {low}) / nullif({high} - {low}, 0))"
    return f"(1 - {share})" if invert else share


def _stretch(column: str) -> str:
    low, high = (f"(SELECT {f}({column}) FROM prepared)" for f in ("min", "max"))
    return f"(({column} - {low}) / nullif({high} - {low}, 0))"


_TOP = " + ".join(f"{w!r} * coalesce({n}, 0)" for n, w in WEIGHTS.items())
_BOTTOM = " + ".join(f"{w!r} * CAST({n} IS NOT NULL AS INTEGER)" for n, w in WEIGHTS.items())
_BASE_NUMBERS = (
    "prix_m2_median",
    "densite_arrets_km2",
    "revenu_median",
    "part_residences_secondaires",
    "taux_delinquance_global",
    "insee_pop",
    "nb_services_sante",
    "nb_loisirs_culture",
    "ensoleillement_h_an",
    "taux_chomage",
    "taux_couverture_emploi",
    "dist_metropole_km",
)
_PREPARED_NUMBERS = (
    "insee_pop_imp",
    "inaccessibilite_brute",
    "inaccessibilite",
    "ensoleillement_impute",
    "dist_metropole_imputee",
    "log_transport",
    "log_risques",
    "tourisme_brut",
    "log_securite",
    "log_services",
    "log_loisirs",
    "log_chomage",
    "log_couverture",
    "dpe_rang",
)
_IDS = "code_commune, nom_commune, code_departement, nb_transactions, dpe_dominant"

STEPS |= {
    "dominant": """
        SELECT code_commune, etiquette_dpe AS dpe_dominant FROM (
            SELECT code_commune, etiquette_dpe, row_number() OVER (
                PARTITION BY code_commune ORDER BY count(*) DESC, etiquette_dpe) AS rk
            FROM label GROUP BY code_commune, etiquette_dpe) AS ranked
        WHERE rk = 1""",
    "based": """
        SELECT p.code_commune, p.nom_commune, p.code_departement, p.nb_transactions,
               p.prix_m2_median, densite_arrets_km2, dpe_dominant, revenu_median,
               nb_arretes_catnat, part_residences_secondaires, taux_delinquance_global,
               CAST(insee_pop AS DOUBLE) AS insee_pop, nb_services_sante, nb_loisirs_culture,
               ensoleillement_h_an, taux_chomage, taux_couverture_emploi, dist_metropole_km
        FROM price AS p
        LEFT JOIN density USING (code_commune) LEFT JOIN dominant USING (code_commune)
        LEFT JOIN (SELECT code_commune, revenu_median FROM income) AS i USING (code_commune)
        LEFT JOIN risk USING (code_commune) LEFT JOIN housing USING (code_commune)
        LEFT JOIN rate USING (code_commune) LEFT JOIN facility USING (code_commune)
        LEFT JOIN climate USING (code_commune) LEFT JOIN job USING (code_commune)
        LEFT JOIN city USING (code_commune)
        WHERE fiable""",
    "imputed": """
        SELECT *, coalesce(insee_pop, median(insee_pop) OVER (PARTITION BY code_departement))
                      AS insee_pop_imp,
               prix_m2_median / revenu_median AS inaccessibilite_brute
        FROM based""",
    "prepared": """
        SELECT *,
               coalesce(inaccessibilite_brute, median(inaccessibilite_brute) OVER ())
                   AS inaccessibilite,
               ln(1 + coalesce(densite_arrets_km2, 0)) AS log_transport,
               ln(1 + coalesce(nb_arretes_catnat, 0)) AS log_risques,
               coalesce(part_residences_secondaires, 0) AS tourisme_brut,
               ln(1 + coalesce(taux_delinquance_global, 0)) AS log_securite,
               ln(1 + coalesce(nb_services_sante / nullif(insee_pop_imp, 0) * 1000, 0))
                   AS log_services,
               ln(1 + coalesce(nb_loisirs_culture / nullif(insee_pop_imp, 0) * 1000, 0))
                   AS log_loisirs,
               coalesce(ensoleillement_h_an, median(ensoleillement_h_an) OVER ())
                   AS ensoleillement_impute,
               ln(1 + coalesce(taux_chomage, median(taux_chomage) OVER ())) AS log_chomage,
               ln(1 + coalesce(taux_couverture_emploi, median(taux_couverture_emploi) OVER ()))
                   AS log_couverture,
               coalesce(dist_metropole_km, median(dist_metropole_km) OVER ())
                   AS dist_metropole_imputee,
               CAST(coalesce(CASE dpe_dominant WHEN 'A' THEN 6 WHEN 'B' THEN 5 WHEN 'C' THEN 4
                    WHEN 'D' THEN 3 WHEN 'E' THEN 2 WHEN 'F' THEN 1 WHEN 'G' THEN 0 END, 3)
                    AS DOUBLE) AS dpe_rang
        FROM imputed""",
    "dimensioned": f"""
        SELECT {_IDS}, prix_m2_median,
               {_norm("prix_m2_median")} AS n_prix,
               {_stretch("log_transport")} AS n_transport,
               {_norm("inaccessibilite", True)} AS n_access_fin,
               {_norm("log_risques", True)} AS n_risques,
               {_norm("tourisme_brut")} AS n_tourisme,
               {_norm("log_securite", True)} AS n_securite,
               {_norm("log_services")} AS n_services,
               {_norm("log_loisirs")} AS n_loisirs,
               {_norm("ensoleillement_impute")} AS n_ensoleillement,
               0.5 * {_norm("log_chomage", True)} + 0.5 * {_norm("log_couverture")} AS n_emploi,
               {_norm("dist_metropole_imputee", True)} AS n_proximite,
               {_stretch("dpe_rang")} AS n_dpe
        FROM prepared""",
    "scored": f"""
        SELECT *, ({_TOP}) / nullif({_BOTTOM}, 0) AS score_valeur FROM dimensioned""",
    "zone_published": """
        SELECT * FROM zone_price
        WHERE fiable AND code_commune IN (SELECT code_commune FROM score_view)""",
    "zone_scored": """
        SELECT z.code_iris, z.code_commune, g.nom_iris, g.type_iris, g.nb_iris_commune,
               s.nom_commune, s.code_departement, z.nb_transactions, z.prix_m2_median,
               z.annee_min, z.annee_max, z.nb_millesimes, n_prix_iris,
               s.score_valeur AS score_commune, s.n_prix AS n_prix_commune,
               s.n_access_fin AS n_access_fin_commune,
               s.score_valeur - n_prix_iris AS gap_iris,
               (s.score_valeur - n_prix_iris) * s.n_access_fin AS gap_pondere_iris
        FROM (SELECT *, (greatest(lo, least(hi, prix_m2_median)) - lo) / nullif(hi - lo, 0)
                         AS n_prix_iris
              FROM zone_published CROSS JOIN (
                  SELECT quantile_cont(prix_m2_median, 0.01) AS lo,
                         quantile_cont(prix_m2_median, 0.99) AS hi FROM zone_published) AS q) AS z
        JOIN zone AS g ON g.code_iris = z.code_iris
        JOIN score_view AS s ON s.code_commune = z.code_commune""",
}

ORACLE |= {
    "dominant_label": "SELECT * FROM dominant",
    "score_base": f"""
        SELECT {_IDS}, nb_arretes_catnat, {rounded(*_BASE_NUMBERS, digits=4)} FROM based""",
    "impute_medians": f"""
        SELECT {_IDS}, nb_arretes_catnat,
               {rounded(*_BASE_NUMBERS, *_PREPARED_NUMBERS, digits=4)} FROM prepared""",
    "territory_score": f"""
        SELECT {_IDS}, {rounded("prix_m2_median", *DIMENSIONS, "score_valeur", digits=4)},
               {half_up("score_valeur - n_prix", 4)} AS gap,
               {half_up("(score_valeur - n_prix) * n_access_fin", 4)} AS gap_pondere
        FROM scored""",
    "normalise_p01_p99": f"""
        SELECT code_commune, {rounded("prix_m2_median")}, {half_up("share")} AS n_prix,
               {half_up("1 - share")} AS n_inverse
        FROM (SELECT code_commune, prix_m2_median,
                     (greatest(lo, least(hi, prix_m2_median)) - lo) / nullif(hi - lo, 0) AS share
              FROM price CROSS JOIN (
                  SELECT quantile_cont(prix_m2_median, 0.01) AS lo,
                         quantile_cont(prix_m2_median, 0.99) AS hi FROM price) AS q) AS n""",
    "normalise_minmax": f"""
        SELECT code_commune, nb_transactions, {half_up("ln(1 + nb_transactions)")} AS volume,
               {half_up("(ln(1 + nb_transactions) - lo) / nullif(hi - lo, 0)")} AS n_volume
        FROM price CROSS JOIN (
            SELECT min(ln(1 + nb_transactions)) AS lo, max(ln(1 + nb_transactions)) AS hi
            FROM price) AS q""",
    "zone_score": f"""
        SELECT code_iris, code_commune, nom_iris, type_iris, nb_iris_commune, nom_commune,
               code_departement, nb_transactions, annee_min, annee_max, nb_millesimes,
               {rounded("prix_m2_median", "n_prix_iris", "score_commune", "n_prix_commune",
                        "n_access_fin_commune", "gap_iris", "gap_pondere_iris")}
        FROM zone_scored""",
}

# --- time series and charts --------------------------------------------------

ORACLE |= {
    "price_evolution": f"""
        SELECT code_commune, annee, nb_transactions, {rounded("prix_m2_median")},
               CAST(row_number() OVER (PARTITION BY code_commune ORDER BY annee) - 1 AS INTEGER)
                   AS rang
        FROM vintage_price""",
    "price_series": f"""
        SELECT c.code_commune, y.annee, {half_up("prix_m2_median", 0)} AS valeur
        FROM (SELECT DISTINCT code_commune FROM vintage_price WHERE nb_transactions >= 5) AS c
        CROSS JOIN (SELECT DISTINCT annee FROM vintage_price) AS y
        LEFT JOIN (SELECT * FROM vintage_price WHERE nb_transactions >= 5) AS v
          ON v.code_commune = c.code_commune AND v.annee = y.annee""",
    "national_weighted_median": f"""
        SELECT annee, {half_up("min(v)", 0)} AS national FROM (
            SELECT annee, prix_m2_median AS v,
                   sum(nb_transactions) OVER (PARTITION BY annee ORDER BY prix_m2_median) AS cw,
                   sum(nb_transactions) OVER (PARTITION BY annee) AS tw
            FROM vintage_price) AS running
        WHERE cw >= tw / 2 GROUP BY annee""",
    "price_histogram": """
        SELECT b.bin, CAST(round(b.bin * w) AS BIGINT) AS bin_start,
               CAST(round((b.bin + 1) * w) AS BIGINT) AS bin_end,
               count(prix_m2) AS tous,
               count(prix_m2) FILTER (type_local = 'Maison') AS maison,
               count(prix_m2) FILTER (type_local = 'Appartement') AS appartement
        FROM (SELECT CAST(unnest(range(60)) AS INTEGER) AS bin) AS b
        CROSS JOIN (SELECT round(quantile_cont(prix_m2, 0.99), -2) AS hi,
                           round(quantile_cont(prix_m2, 0.99), -2) / 60e0 AS w FROM clipped) AS q
        LEFT JOIN clipped ON prix_m2 <= hi AND least(floor(prix_m2 / w), 59) = b.bin
        GROUP BY b.bin, w""",
    "points_sample": f"""
        SELECT {half_up("longitude", 4)} AS lon, {half_up("latitude", 4)} AS lat,
               CAST({half_up("prix_m2", 0)} AS INTEGER) AS prix,
               CASE type_local WHEN 'Maison' THEN 'M' ELSE 'A' END AS t
        FROM (SELECT * FROM clipped ORDER BY md5(id_mutation || '42'), id_mutation LIMIT 500)
            AS sample""",
}

# --- maps, documents, indexes ------------------------------------------------

_TYPED = """
        max(prix_m2_median) FILTER (type_local = 'Maison') AS maison_prix_m2_median,
        max(nb_transactions) FILTER (type_local = 'Maison') AS maison_nb_transactions,
        bool_or(fiable) FILTER (type_local = 'Maison') AS maison_fiable,
        max(prix_m2_median) FILTER (type_local = 'Appartement') AS appart_prix_m2_median,
        max(nb_transactions) FILTER (type_local = 'Appartement') AS appart_nb_transactions,
        bool_or(fiable) FILTER (type_local = 'Appartement') AS appart_fiable"""
_PRICES = ", ".join(
    f"{half_up(p + 'prix_m2_median')} AS {p}prix_m2_median, "
    f"coalesce({p}nb_transactions, 0) AS {p}nb_transactions, "
    f"coalesce({p}fiable, false) AS {p}fiable"
    for p in ("", "maison_", "appart_")
)
_MEDIANS = ", ".join(f"{half_up(f'median({n})', 3)} AS {n}" for n in DIMENSIONS)
_DEPT_OF = (
    "CASE WHEN code_commune LIKE '97%' THEN substr(code_commune, 1, 3) "
    "ELSE substr(code_commune, 1, 2) END"
)


def _map_medians(source: str, key: str) -> str:
    return f"""
        SELECT {key}, count(*) AS nb_communes_scorees,
               {half_up("median(score_valeur)", 3)} AS score_median,
               {half_up("median(gap_pondere)", 3)} AS gap_pondere_median, {_MEDIANS}
        FROM {source} GROUP BY {key}"""


STEPS |= {
    "type_flat": f"SELECT code_commune, {_TYPED} FROM price_type GROUP BY code_commune",
    "commune_map": f"""
        SELECT b.code_commune, b.nom_commune AS nom, b.code_departement,
               p.prix_m2_median, p.nb_transactions, p.fiable,
               t.* EXCLUDE (code_commune),
               s.score_valeur, s.gap_pondere, {half_up("s.gap", 3)} AS gap, s.dpe_dominant,
               {rounded(*DIMENSIONS, digits=3, prefix="s.")}
        FROM box AS b
        LEFT JOIN price AS p ON p.code_commune = b.code_commune
        LEFT JOIN type_flat AS t ON t.code_commune = b.code_commune
        LEFT JOIN score_view AS s ON s.code_commune = b.code_commune""",
    "region_sale": """
        SELECT c.*, r.code_region FROM clipped AS c JOIN region_map AS r
        ON r.code_departement = c.code_departement""",
    "region_price": """
        SELECT code_region, type_local, count(*) AS nb_transactions,
               median(prix_m2) AS prix_m2_median, count(*) >= 5 AS fiable
        FROM region_sale GROUP BY GROUPING SETS ((code_region), (code_region, type_local))""",
    "region_score": """
        SELECT s.*, r.code_region FROM score_view AS s JOIN region_map AS r
        ON r.code_departement = s.code_departement""",
    "base_commune": """
        SELECT code_commune, nom_commune FROM ref
        UNION
        SELECT code_commune, nom_commune FROM score_view
        WHERE code_commune NOT IN (SELECT code_commune FROM ref)""",
}


def _territory_map(shape: str, key: str, prices: str, medians: str, extra: str = "") -> str:
    return f"""
        SELECT g.{key}, g.nom, {extra} {_PRICES}, score_median, gap_pondere_median,
               coalesce(nb_communes_scorees, 0) AS nb_communes_scorees,
               {", ".join(DIMENSIONS)}
        FROM ({shape}) AS g
        LEFT JOIN (SELECT {key}, prix_m2_median, nb_transactions, fiable FROM {prices}
                   WHERE type_local IS NULL) AS a ON a.{key} = g.{key}
        LEFT JOIN (SELECT {key}, {_TYPED} FROM {prices} GROUP BY {key}) AS t ON t.{key} = g.{key}
        LEFT JOIN ({medians}) AS m ON m.{key} = g.{key}"""


ORACLE |= {
    "choropleth_flat": f"""
        SELECT b.code_commune, b.nom_commune, b.code_departement, s.type_local, s.fiable,
               s.nb_transactions, true AS has_low, true AS has_mid, true AS has_high,
               s.prix_m2_median, s.prix_m2_p25, s.prix_m2_p75
        FROM box AS b JOIN ({_spread("single", "code_commune, type_local")}) AS s
          ON s.code_commune = b.code_commune""",
    "choropleth_commune": f"""
        SELECT code_commune, nom, code_departement, {_PRICES}, gap, dpe_dominant,
               {rounded("score_valeur", "gap_pondere")}, {", ".join(DIMENSIONS)}
        FROM commune_map""",
    "choropleth_dept": _territory_map(
        "SELECT d.code_departement, nom_departement AS nom, code_region, nom_region "
        "FROM dept_box AS d LEFT JOIN region_map AS r ON r.code_departement = d.code_departement",
        "code_departement",
        "price_dept",
        _map_medians("score_view", "code_departement"),
        "code_region, nom_region,",
    ),
    "choropleth_region": _territory_map(
        "SELECT code_region, nom_region AS nom FROM region_box "
        "WHERE code_region IN (SELECT code_region FROM region_map)",
        "code_region",
        "region_price",
        _map_medians("region_score", "code_region"),
    ),
    "choropleth_zone": f"""
        SELECT g.code_iris, g.code_commune, g.nom_iris AS nom, g.nom_commune, g.type_iris,
               substr(g.code_commune, 1, 2) AS code_departement,
               CAST({half_up("q.prix_m2_median", 0)} AS INTEGER) AS prix_m2_median,
               coalesce(q.nb_transactions, 0) AS nb_transactions,
               q.code_iris IS NOT NULL AS fiable,
               {rounded("n_prix_iris", "score_commune", "gap_iris", "gap_pondere_iris", digits=3)},
               q.annee_min, q.annee_max
        FROM zone AS g LEFT JOIN zone_scored AS q ON q.code_iris = g.code_iris
        WHERE g.nb_iris_commune > 1""",
    "territory_document": f"""
        SELECT b.code_commune, b.nom_commune, substr(b.code_commune, 1, 2) AS code_departement,
               p.code_commune IS NULL AS sans_prix,
               {half_up("p.prix_m2_median", 4)} AS prix_median,
               {half_up("t.maison_prix_m2_median", 4)} AS maison_median,
               t.appart_nb_transactions AS appartement_n,
               CAST(e.annees AS INTEGER) AS annees,
               s.code_commune IS NULL AS sans_score, {half_up("s.n_emploi", 4)} AS n_emploi,
               {half_up("i.revenu_median", 4)} AS revenu_median, m.nom_metropole,
               {half_up("g.surface_km2", 4)} AS surface_km2,
               a.code_commune IS NULL AS sans_avis, a.n_avis, w.word AS premier_mot
        FROM base_commune AS b
        LEFT JOIN density AS g ON g.code_commune = b.code_commune
        LEFT JOIN price AS p ON p.code_commune = b.code_commune
        LEFT JOIN type_flat AS t ON t.code_commune = b.code_commune
                                AND p.code_commune IS NOT NULL
        LEFT JOIN (SELECT code_commune, count(*) AS annees FROM vintage_price
                   GROUP BY code_commune) AS e ON e.code_commune = b.code_commune
        LEFT JOIN score_view AS s ON s.code_commune = b.code_commune
        LEFT JOIN income AS i ON i.code_commune = b.code_commune
        LEFT JOIN city AS m ON m.code_commune = b.code_commune
        LEFT JOIN meta AS a ON a.code_commune = b.code_commune
        LEFT JOIN (SELECT * FROM cloud WHERE rang = 1) AS w ON w.code_commune = b.code_commune""",
    "search_index": f"""
        SELECT b.code_commune AS c, b.nom_commune AS n, substr(b.code_commune, 1, 2) AS d,
               CAST({half_up("p.prix_m2_median", 0)} AS INTEGER) AS p,
               {half_up("s.score_valeur", 2)} AS s
        FROM base_commune AS b LEFT JOIN price AS p ON p.code_commune = b.code_commune
        LEFT JOIN score_view AS s ON s.code_commune = b.code_commune""",
    "ranking_top_n": f"""
        SELECT CAST(row_number() OVER (ORDER BY gap_pondere DESC, code_commune) AS INTEGER)
                   AS rang,
               code_commune, nom_commune, code_departement, prix_m2_median,
               {rounded("score_valeur", digits=4)},
               {half_up("gap_pondere", 4)} AS gap_pondere
        FROM (SELECT * FROM score_view ORDER BY gap_pondere DESC, code_commune LIMIT 100) AS top""",
    "territory_stats": f"""
        SELECT s.code_commune, s.nom_commune AS nom, s.code_departement AS dep,
               {half_up("s.prix_m2_median", 0)} AS prix_m2_median, s.nb_transactions,
               {rounded("taux_chomage", "taux_couverture_emploi", "densite_arrets_km2", digits=2)},
               {rounded("revenu_median", "ensoleillement_h_an", digits=0)}, jours_ensoleilles,
               {rounded("temperature_moy_annuelle", "dist_metropole_km", digits=1)},
               {rounded("part_residences_secondaires", digits=4)}, nb_arrets
        FROM score_view AS s
        LEFT JOIN job USING (code_commune)
        LEFT JOIN (SELECT code_commune, revenu_median FROM income) AS i USING (code_commune)
        LEFT JOIN climate USING (code_commune) LEFT JOIN housing USING (code_commune)
        LEFT JOIN city USING (code_commune) LEFT JOIN density USING (code_commune)""",
    "score_flat": f"""
        SELECT code_commune, nom, code_departement AS dep,
               CAST({half_up("prix_m2_median", 0)} AS INTEGER) AS prix,
               coalesce(nb_transactions, 0) AS nb_transactions, dpe_dominant AS dpe, gap,
               {rounded("score_valeur", "gap_pondere", digits=3)}, {", ".join(DIMENSIONS)}
        FROM commune_map WHERE score_valeur IS NOT NULL""",
}

# --- reviews -----------------------------------------------------------------


def _number(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}), ',', '.') AS DOUBLE)"


def _pieces(column: str) -> str:
    """Segments of a text: hard breaks, sentence ends marked then split, short ones dropped."""
    chunks = f"string_split_regex({column}, '[→▶•\\n\\r]+')"
    sentences = (
        f"flatten(list_transform({chunks}, lambda c: string_split("
        "regexp_replace(c, '([.!?…])\\s+', '\\1' || chr(1), 'g'), chr(1))))"
    )
    tidy = f"list_transform({sentences}, lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g')))"
    return f"list_filter({tidy}, lambda s: length(s) >= 15)"


def _quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_THEME_LIST = ", ".join(
    "CASE WHEN regexp_matches(text, '{}') THEN '{}' END".format(
        theme_pattern(terms).replace("'", "''"), theme
    )
    for theme, terms in VOCABULARY.items()
)
_CLASS = (
    "CASE WHEN {0} >= 0.15 THEN 'positive' WHEN {0} <= -0.15 THEN 'negative' ELSE 'neutral' END"
)

STEPS |= {
    "review": f"""
        SELECT substr(sha1(slug || '|' || date || '|' || auteur || '|'
                           || CAST(doc_id AS VARCHAR)), 1, 16) AS avis_id,
               lpad(code_commune, 5, '0') AS code_commune, slug, nom_ville,
               CAST(TRY_STRPTIME(date, '%d-%m-%Y') AS DATE) AS date_avis,
               {_number("note_moyenne")} AS note_moyenne,
               {_number("environnement")} AS note_environnement,
               points_positifs, points_negatifs,
               CAST(length(points_positifs) + length(points_negatifs) AS INTEGER) AS n_chars
        FROM review_raw""",
    "segment": f"""
        SELECT avis_id, code_commune, date_avis,
               CAST(unnest(range(len(texts))) AS INTEGER) AS segment_id,
               unnest(texts) AS text, unnest(sides) AS polarity_field
        FROM (SELECT avis_id, code_commune, date_avis, list_concat(pos, neg) AS texts,
                     list_concat(list_transform(pos, lambda t: 'positif'),
                                 list_transform(neg, lambda t: 'negatif')) AS sides
              FROM (SELECT avis_id, code_commune, date_avis,
                           {_pieces("points_positifs")} AS pos,
                           {_pieces("points_negatifs")} AS neg FROM review) AS cut) AS both_sides""",
    "said": """
        SELECT avis_id, segment_id, polarity_field = 'positif' AS up,
               substr(avis_id, 1, 1) NOT IN ('0', '1', '2') AS seen,
               unnest(list_distinct(list_filter(regexp_extract_all(lower(text), '\\p{L}+'),
                                                lambda w: length(w) >= 3))) AS word
        FROM segment""",
    "word_weight": """
        SELECT word, CAST(round(1000e0 * ln(((p + 1) / (up + 2e0)) / ((n + 1) / (down + 2e0)))
                                * ((p + n) / (p + n + 20e0))) AS BIGINT) AS weight
        FROM (SELECT word, count(*) FILTER (up) AS p, count(*) FILTER (NOT up) AS n
              FROM said WHERE seen GROUP BY word HAVING count(*) >= 5) AS counted,
             (SELECT count(*) FILTER (polarity_field = 'positif') AS up,
                     count(*) FILTER (polarity_field <> 'positif') AS down
              FROM segment WHERE substr(avis_id, 1, 1) NOT IN ('0', '1', '2')) AS sides""",
    "word_score": """
        SELECT avis_id, segment_id, CAST(sum(weight) AS BIGINT) AS total
        FROM said JOIN word_weight USING (word) GROUP BY avis_id, segment_id""",
    "modelled": f"""
        SELECT s.*, list_filter([{_THEME_LIST}], lambda t: t IS NOT NULL) AS themes,
               CASE WHEN polarity_field = 'positif' THEN 1e0 ELSE -1e0 END AS prior,
               total / (abs(total) + 1000e0) AS model_score
        FROM segment AS s LEFT JOIN word_score AS w
          ON w.avis_id = s.avis_id AND w.segment_id = s.segment_id""",
    "tone": """
        SELECT *, CASE WHEN model_score IS NULL THEN prior * 0.6e0
                       ELSE greatest(-1, least(1, prior * 0.35e0 + model_score * 0.65e0)) END
                      AS sentiment,
               CASE WHEN model_score IS NOT NULL
                    THEN (model_score >= 0) = (prior >= 0) END AS concordant
        FROM modelled""",
    "worded": "SELECT *, regexp_extract_all(lower(text), '\\p{L}+') AS words FROM tone",
    "flagged": f"""
        SELECT *, list_transform(words, lambda w: length(w) >= 3 AND NOT list_contains(
                   {_quoted((*STOP_WORDS, *GENERIC_WORDS))}, w)) AS good
        FROM worded""",
    "token": """
        SELECT DISTINCT code_commune, avis_id, segment_id, sentiment, themes, item.t AS token,
               item.k AS kind
        FROM (SELECT code_commune, avis_id, segment_id, sentiment, themes, unnest(list_concat(
                  list_transform(list_filter(range(1, len(words) + 1), lambda i: good[i]),
                                 lambda i: {'t': words[i], 'k': 'nom'}),
                  list_transform(
                      list_filter(range(1, len(words)), lambda i: good[i] AND good[i + 1]),
                      lambda i: {'t': words[i] || ' ' || words[i + 1], 'k': 'bigramme'})
                  )) AS item FROM flagged) AS items""",
    "voted": "SELECT code_commune, avis_id, avg(sentiment) AS vote, count(*) AS n FROM tone GROUP BY ALL",
    "meta": f"""
        SELECT r.code_commune, min(nom_ville) AS nom_ville,
               count(DISTINCT r.avis_id) AS n_avis, min(date_avis) AS date_min,
               max(date_avis) AS date_max, {half_up("avg(vote)", 4)} AS sentiment_global,
               count(DISTINCT r.avis_id) < 10 AS low_data
        FROM review AS r LEFT JOIN voted AS v
          ON v.code_commune = r.code_commune AND v.avis_id = r.avis_id
        GROUP BY r.code_commune""",
    "themed": f"""
        SELECT code_commune, theme, count(*) AS n_segments,
               {half_up("avg(CAST(sentiment >= 0.15 AS INTEGER))", 3)} AS pct_positive,
               {half_up("avg(CAST(sentiment <= -0.15 AS INTEGER))", 3)} AS pct_negative,
               {half_up("avg(sentiment)", 3)} AS score
        FROM (SELECT code_commune, unnest(themes) AS theme, sentiment FROM tone) AS mentions
        GROUP BY code_commune, theme HAVING count(*) >= 3""",
    "cloud": f"""
        SELECT code_commune, CAST(rang AS INTEGER) AS rang, token AS word, weight,
               {_CLASS.format("round(tone_mean, 9)")} AS sentiment, themes
        FROM (SELECT *, row_number() OVER (PARTITION BY code_commune
                                           ORDER BY weight DESC, token) AS rang
              FROM (SELECT code_commune, token, count(DISTINCT avis_id) AS weight,
                           avg(sentiment) AS tone_mean,
                           list_sort(list_distinct(flatten(list(themes)))) AS themes
                    FROM token GROUP BY code_commune, token) AS words) AS ranked
        WHERE rang <= 40""",
    "quote": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY code_commune, label ORDER BY
                       abs(sentiment) DESC, date_avis DESC NULLS LAST, avis_id) AS rang
            FROM (SELECT *, row_number() OVER (PARTITION BY code_commune, avis_id
                             ORDER BY abs(sentiment) DESC, segment_id) AS rk,
                         CASE WHEN concordant = false OR abs(sentiment) < 0.25 THEN 'Nuancé'
                              WHEN sentiment >= 0.25 THEN 'Positif' ELSE 'Négatif' END AS label
                  FROM tone WHERE length(text) BETWEEN 80 AND 300) AS candidates
            WHERE rk = 1) AS ranked
        WHERE (label = 'Positif' AND rang <= 3) OR (label = 'Négatif' AND rang <= 3)
           OR (label = 'Nuancé' AND rang <= 2)""",
    "rolled": """
        SELECT m.*, coalesce(t.themes, '') AS themes, coalesce(w.mots, '') AS mots,
               coalesce(w.apercu, '') AS apercu, coalesce(q.citations, '') AS citations,
               coalesce(w.n_mots, 0) AS n_mots
        FROM meta AS m
        LEFT JOIN (SELECT code_commune, string_agg(theme, ',' ORDER BY n_segments DESC, theme)
                              AS themes FROM themed GROUP BY code_commune) AS t
          ON t.code_commune = m.code_commune
        LEFT JOIN (SELECT code_commune, string_agg(word, ',' ORDER BY rang) AS mots,
                          string_agg(word, ',' ORDER BY rang) FILTER (rang <= 7) AS apercu,
                          CAST(count(*) AS INTEGER) AS n_mots
                   FROM cloud GROUP BY code_commune) AS w ON w.code_commune = m.code_commune
        LEFT JOIN (SELECT code_commune, string_agg(label, ',' ORDER BY label, rang) AS citations
                   FROM quote GROUP BY code_commune) AS q ON q.code_commune = m.code_commune""",
    "rated": """
        SELECT r.avis_id, (note_moyenne - 5) / 5 AS y, vote AS x
        FROM review AS r JOIN voted AS v ON v.avis_id = r.avis_id
        WHERE note_moyenne IS NOT NULL""",
}

ORACLE |= {
    "reviews_clean": """
        SELECT * REPLACE (CAST(date_avis AS VARCHAR) AS date_avis) FROM review""",
    "review_segments": """
        SELECT * REPLACE (CAST(date_avis AS VARCHAR) AS date_avis) FROM segment""",
    "segment_themes": """
        SELECT avis_id, segment_id, array_to_string(themes, ',') AS themes FROM modelled""",
    "segment_tokens": """
        SELECT code_commune, kind, token, count(*) AS n, count(DISTINCT avis_id) AS n_avis
        FROM token GROUP BY code_commune, kind, token""",
    "segment_sentiment": f"""
        SELECT avis_id, code_commune, segment_id, polarity_field, concordant,
               {rounded("model_score", "sentiment")} FROM tone""",
    "segment_sentiment_prior": """
        SELECT avis_id, segment_id,
               CASE WHEN polarity_field = 'positif' THEN 0.6e0 ELSE -0.6e0 END AS sentiment,
               CAST(NULL AS BOOLEAN) AS concordant FROM segment""",
    "segment_sentiment_batch": f"""
        SELECT avis_id, code_commune, segment_id, polarity_field, concordant,
               {rounded("model_score", "sentiment")} FROM tone""",
    "segment_stars": """
        SELECT avis_id, segment_id, round(model_score, 6) AS score,
               round(greatest(0, 1 - abs(2 * model_score + 2)), 6) AS p1,
               round(greatest(0, 1 - abs(2 * model_score + 1)), 6) AS p2,
               round(greatest(0, 1 - abs(2 * model_score)), 6) AS p3,
               round(greatest(0, 1 - abs(2 * model_score - 1)), 6) AS p4,
               round(greatest(0, 1 - abs(2 * model_score - 2)), 6) AS p5
        FROM tone WHERE model_score IS NOT NULL""",
    "sentiment_holdout": f"""
        SELECT (SELECT count(*) FROM tone
                WHERE substr(avis_id, 1, 1) IN ('0', '1', '2') AND model_score IS NOT NULL) AS n_segments,
               (SELECT round(avg(CAST((model_score >= 0) = (polarity_field = 'positif') AS INTEGER)), 6)
                FROM tone WHERE substr(avis_id, 1, 1) IN ('0', '1', '2')
                  AND model_score IS NOT NULL) AS agreement,
               count(*) AS n, {half_up("corr(x, y)", 4)} AS pearson,
               {half_up("corr(rx, ry)", 4)} AS spearman
        FROM (SELECT x, y,
                     rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
                     rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry
              FROM (SELECT avg(model_score) AS x, any_value((note_moyenne - 5) / 5) AS y
                    FROM tone JOIN review USING (avis_id)
                    WHERE substr(avis_id, 1, 1) IN ('0', '1', '2') AND model_score IS NOT NULL
                      AND note_moyenne IS NOT NULL
                    GROUP BY avis_id) AS held) AS ranked""",
    "calibration": f"""
        SELECT count(*) AS n, {half_up("corr(x, y)", 4)} AS pearson,
               {half_up("corr(rx, ry)", 4)} AS spearman
        FROM (SELECT x, y,
                     rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
                     rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry
              FROM rated) AS ranked""",
    "review_sentiment": f"""
        SELECT r.avis_id, r.code_commune, slug, nom_ville,
               CAST(date_avis AS VARCHAR) AS date_avis, note_moyenne, note_environnement,
               {half_up("vote")} AS sentiment_avis,
               CAST(coalesce(n, 0) AS INTEGER) AS n_segments, n_chars,
               'words' AS model_name, '1' AS nlp_version
        FROM review AS r LEFT JOIN voted AS v ON v.avis_id = r.avis_id""",
    "review_meta": """
        SELECT * REPLACE (CAST(date_min AS VARCHAR) AS date_min,
                          CAST(date_max AS VARCHAR) AS date_max) FROM meta""",
    "review_themes": """
        SELECT code_commune, theme, n_segments, pct_positive, pct_negative, score,
               CAST(row_number() OVER (PARTITION BY code_commune
                    ORDER BY n_segments DESC, theme) - 1 AS INTEGER) AS rang
        FROM themed""",
    "wordcloud": """
        SELECT code_commune, rang, word, weight, sentiment,
               array_to_string(themes, ',') AS themes FROM cloud""",
    "verbatims": f"""
        SELECT code_commune, text, label, coalesce(themes[1], 'autre') AS theme,
               strftime(date_avis, '%Y-%m') AS mois, '{SOURCE}' AS source,
               CAST(row_number() OVER (PARTITION BY code_commune ORDER BY label, rang) - 1
                    AS INTEGER) AS rang
        FROM quote""",
    "review_rollup": """
        SELECT code_commune, nom_ville, n_avis, CAST(date_min AS VARCHAR) AS date_min,
               CAST(date_max AS VARCHAR) AS date_max, sentiment_global, low_data, themes, mots,
               apercu, citations FROM rolled""",
    "review_export": f"""
        SELECT code_commune, substr(code_commune, 1, 2) AS code_departement, n_avis,
               CAST(date_min AS VARCHAR) AS debut, CAST(date_max AS VARCHAR) AS fin,
               {half_up("sentiment_global", 2)} AS sentiment_global, low_data,
               low_data AS sans_themes, n_mots, '{SOURCE}' AS source FROM rolled""",
    "review_index": f"""
        SELECT m.code_commune AS c, nom_ville AS n, n_avis, {half_up("lon", 4)} AS lng,
               {half_up("lat", 4)} AS lat
        FROM meta AS m JOIN centre AS c ON c.code_commune = m.code_commune""",
}

# --- raw parsers -------------------------------------------------------------

ORACLE |= {
    "station_sheets": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS num_poste,
               {half_up("""(CASE WHEN s_suppkey % 4 = 0 THEN -1 ELSE 1 END) * (42 + s_suppkey % 9
                   + (s_suppkey % 60) / 60e0 + (s_suppkey * 7 % 60) / 3600e0)""", 5)} AS lat,
               {half_up("""(CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END) * (s_suppkey % 7
                   + (s_suppkey * 11 % 60) / 60e0 + (s_suppkey * 13 % 60) / 3600e0)""", 5)} AS lon,
               1500.5e0 + s_suppkey % 900 AS ensoleillement_h_an,
               8.9e0 + s_suppkey % 9 AS temperature_moy_annuelle
        FROM supplier WHERE s_suppkey % 5 <> 0""",
    "page_blocks": """
        SELECT page_id, titre, CAST(unnest(range(len(blocs))) AS INTEGER) AS rang,
               unnest(blocs) AS bloc
        FROM (SELECT page_id,
                     trim(regexp_extract(html, '<h1>\\s*(.+?)\\s*(?:\\(\\d+\\))?\\s*</h1>', 1))
                         AS titre,
                     list_transform(string_split(html, '<p>')[2:],
                                    lambda p: string_split(p, '</article>')[1]) AS blocs
              FROM pages) AS cut""",
    "review_pages": """
        SELECT slug, code_commune, nom_ville, date, auteur,
               replace(note_moyenne, ',', '.') AS note_moyenne, environnement,
               '' AS transports, '' AS securite, '' AS sante, '' AS sports_et_loisirs,
               '' AS culture, '' AS enseignement, '' AS commerces, '7' AS qualite_de_vie,
               regexp_replace(replace(points_positifs, '<', ' '), '^\\s+|\\s+$', '', 'g')
                   AS points_positifs,
               regexp_replace(replace(points_negatifs, '<', ' '), '^\\s+|\\s+$', '', 'g')
                   AS points_negatifs
        FROM review_raw WHERE note_moyenne <> ''""",
    "keyed_json_flatten": """
        SELECT 'ville-' || CAST(c_custkey AS VARCHAR) || '_'
                   || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS slug,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS code_commune, c_name AS nom_ville,
               CAST(c_custkey AS VARCHAR) AS code_postal,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 10 AS VARCHAR) ELSE '' END
                   AS note_globale,
               '' AS environnement, '' AS transports, '' AS securite, '' AS sante,
               '' AS sports_et_loisirs, '5' AS culture, '' AS enseignement, '' AS commerces,
               '' AS qualite_de_vie
        FROM customer""",
    "land_new_files": """
        SELECT 'source=docs/dataset=' || lang || '/ingestion_date=2024-01-01/'
                   || CAST(doc_id AS VARCHAR) || '.txt' AS landing_key,
               sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes
        FROM documents WHERE doc_id % 3 <> 0""",
    "land_three_times": """
        SELECT lang AS dataset, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
               (SELECT count(*) FROM documents WHERE doc_id % 3 < 2) AS landing_1,
               (SELECT count(*) FROM documents WHERE doc_id % 3 = 2 OR text <> upper(text)) AS landing_2,
               CAST(0 AS BIGINT) AS landing_3
        FROM documents GROUP BY lang""",
}

# --- quality -----------------------------------------------------------------


def _violations(table: str, rules, label: str = "") -> str:
    head = f"'{label}' AS \"table\", " if label else ""
    return " UNION ALL ".join(
        f"""SELECT {head} '{r.name.replace("'", "''")}' AS regle, bad AS violations,
                   {half_up("100e0 * bad / total", 3)} AS pct,
                   {str(r.critical).lower()} AS critique,
                   CASE WHEN bad = 0 THEN 'OK' ELSE 'KO' END AS statut
            FROM (SELECT count(*) FILTER ({r.violation}) AS bad, count(*) AS total
                  FROM {table}) AS counted"""
        for r in rules
    )


#: Rule pack of the gate -> step that holds its table (outlines are boxes here).
_SILVER = {
    "ventes": "sale",
    "iris_geom": "(SELECT *, min_x AS geom FROM zone) AS shaped",
    "iris_prix": "zone_price",
    "commune_transport": "density",
    "revenus": "income",
    "risques": "risk",
    "equipements": "facility",
    "securite": "rate",
    "emploi": "job",
    "climat": "climate",
    "tourisme": "housing",
    "proximite_metropole": "city",
    "dpe": "label",
    "avis": "review",
    "avis_segments": "tone",
}
_OUTLINE = f"(SELECT code_commune, min_x AS geom, {_AREA} AS surface_km2 FROM box) AS shaped"


def _profiled(position: int, name: str, kind: str, numeric: bool) -> str:
    spread = (
        f"CAST(min({name}) AS DOUBLE) AS min, {half_up(f'CAST(median({name}) AS DOUBLE)')} AS "
        f"mediane, CAST(max({name}) AS DOUBLE) AS max"
        if numeric
        else "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS mediane, "
        "CAST(NULL AS DOUBLE) AS max"
    )
    return f"""
        SELECT {position} AS position, '{name}' AS colonne, '{kind}' AS type,
               {half_up(f"100e0 * count(*) FILTER ({name} IS NULL) / count(*)", 2)}
                   AS pct_manquant,
               count(DISTINCT {name}) AS cardinalite, {spread} FROM customer"""


def _covered(label: str, source: str, limit: float | None, note: str) -> str:
    n = f"(SELECT count(DISTINCT code_commune) FROM {source})" if source else "0"
    rate = half_up(f"100e0 * {n} / (SELECT count(DISTINCT code_commune) FROM box)", 1)
    alert = f"CASE WHEN {rate} < {limit} THEN '{note}' ELSE '' END" if limit else "''"
    alert = alert if source else "'table absente'"
    return f"SELECT '{label}' AS source, CAST({n} AS BIGINT) AS communes, {rate} AS taux_pct, {alert} AS alerte"


_MISSING_TEXT = ("id_mutation", "numero_disposition", "nature_mutation", "type_local",
                 "code_commune", "nom_commune", "code_departement", "date_mutation")
_MISSING_NUMBER = ("valeur_fonciere", "surface_reelle_bati", "longitude", "latitude")


def _figures(section: str, pairs: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{name}' AS mesure, "
        f"{half_up(f'CAST({value} AS DOUBLE)', 4)} AS valeur FROM {source}"
        for name, value in pairs.items()
    )


_BUILT = "type_local IN ('Maison', 'Appartement')"

STEPS |= {
    "per_sale": """
        SELECT id_mutation, count(*) AS n, count(DISTINCT valeur_fonciere) AS nv,
               count(DISTINCT numero_disposition) AS nd
        FROM sale_raw GROUP BY id_mutation""",
    "lone": f"""
        SELECT min(type_local) AS type_local,
               min(valeur_fonciere) / min(surface_reelle_bati) AS prix_m2
        FROM sale_raw WHERE {_BUILT} GROUP BY id_mutation
        HAVING count(*) = 1 AND min(surface_reelle_bati) > 0 AND min(valeur_fonciere) > 0""",
    "per_commune": f"""
        SELECT code_commune, count(*) AS n,
               count(DISTINCT type_local) FILTER ({_BUILT}) AS nt
        FROM sale_raw GROUP BY code_commune""",
    "ranked_before": """
        SELECT code_commune, row_number() OVER (ORDER BY score_valeur DESC, code_commune) AS a
        FROM score_view QUALIFY a <= 25""",
    "ranked_after": """
        SELECT code_commune, row_number() OVER (ORDER BY gap_pondere DESC, code_commune) AS b
        FROM score_view QUALIFY b <= 25""",
    "shared_ranks": "SELECT * FROM ranked_before JOIN ranked_after USING (code_commune)",
}

ORACLE |= {
    "profile_table": " UNION ALL ".join(
        [
            _profiled(0, "c_custkey", "bigint", True),
            _profiled(1, "c_name", "string", False),
            _profiled(2, "c_nationkey", "int", False),
            _profiled(3, "c_acctbal", "double", True),
            _profiled(4, "c_mktsegment", "string", False),
        ]
    ),
    "validate_rules": _violations("sale", RULES["ventes"]),
    "coverage": " UNION ALL ".join(
        [
            _covered("risques", "risk", 10.0, "couverture faible"),
            _covered("avis", "review", 50.0, "corpus partiel"),
            _covered("emploi", "job", None, ""),
            _covered("climat", "", None, ""),
        ]
    ),
    "match_rate": f"""
        SELECT l AS cles_left, m AS appariees, l - m AS orphelines,
               {half_up("100e0 * m / l", 2)} AS taux
        FROM (SELECT count(DISTINCT code) AS l,
                     count(DISTINCT code) FILTER (code IN (SELECT code_commune FROM zone)) AS m
              FROM (SELECT CASE WHEN code_commune LIKE '%007' THEN 'X' || code_commune
                                ELSE code_commune END AS code
                    FROM line) AS recoded) AS keys""",
    "dq_report": " UNION ALL ".join(
        _violations(step, RULES[name], name) for name, step in _SILVER.items()
    ),
    "geometry_rules": _violations(_OUTLINE, RULES["commune_geom"]),
    "silver_gate": " UNION ALL ".join(
        [
            *(
                f"""SELECT 'rules' AS section, "table", regle, violations AS nombre, pct, critique, statut
                    FROM ({_violations(step, RULES[name], name)}) AS rules"""
                for name, step in _SILVER.items()
                if name != "avis_segments"
            ),
            "SELECT 'rules', 'avis_segments', NULL, NULL, NULL, false, 'absente'",
            *(
                f"""SELECT 'coverage', '{name}', NULL, n, {half_up("100e0 * n / total", 1)}, false, 'OK'
                    FROM (SELECT (SELECT count(DISTINCT code_commune) FROM {step}) AS n,
                                 (SELECT count(DISTINCT code_commune) FROM ref) AS total) AS counted"""
                for name, step in _SILVER.items()
                if name != "avis_segments"
            ),
            f"""SELECT 'match', 'ventes', 'iris_geom', l - m, {half_up("100e0 * m / l", 2)}, false, 'OK'
                FROM (SELECT count(DISTINCT code_commune) AS l,
                             count(DISTINCT code_commune)
                                 FILTER (code_commune IN (SELECT code_commune FROM zone)) AS m
                      FROM sale) AS keys""",
        ]
    ),
    "gold_checks": """
        SELECT count(*) AS nb_communes_scorees,
               count(*) FILTER (score_valeur IS NULL) AS nb_score_null,
               count(*) FILTER (gap < -1 OR gap > 1) AS nb_gap_hors_bornes FROM score_view""",
    "zone_checks": """
        SELECT count(*) AS nb_iris_scores,
               count(*) - count(DISTINCT code_iris) AS nb_code_iris_dupliques,
               count(*) FILTER (n_prix_iris IS NULL OR n_prix_iris < 0 OR n_prix_iris > 1)
                   AS nb_n_prix_hors_bornes,
               count(*) FILTER (gap_iris < -1 OR gap_iris > 1) AS nb_gap_hors_bornes,
               count(*) FILTER (score_commune IS NULL) AS nb_score_commune_null
        FROM zone_scored""",
    "review_checks": """
        SELECT count(*) AS nb_communes_avis,
               count(*) FILTER (sentiment_global < -1 OR sentiment_global > 1)
                   AS nb_sentiment_hors_bornes,
               count(*) FILTER (n_avis <= 0) AS nb_n_avis_non_positif,
               count(*) FILTER (low_data <> (n_avis < 10)) AS nb_low_data_incoherent,
               count(*) FILTER (n_avis > 0 AND n_mots = 0) AS nb_wordcloud_vide FROM rolled""",
    "rank_stability": f"""
        SELECT count(*) AS communs,
               {half_up("""CASE WHEN count(*) < 2 THEN 1e0 ELSE (
                   SELECT sum(CASE WHEN y.b > x.b THEN 1e0 ELSE -1e0 END) / count(*)
                   FROM shared_ranks AS x JOIN shared_ranks AS y ON x.a < y.a) END""")} AS tau
        FROM shared_ranks""",
    "sales_profile": " UNION ALL ".join(
        [
            _figures(
                "manquants",
                {
                    **{c: f"avg(CAST({c} IS NULL OR trim({c}) = '' AS INTEGER))"
                       for c in _MISSING_TEXT},
                    **{c: f"avg(CAST({c} IS NULL AS INTEGER))" for c in _MISSING_NUMBER},
                },
                "sale_raw",
            ),
            _figures(
                "cardinalites",
                {
                    c: f"count(DISTINCT {c})"
                    for c in ("id_mutation", "code_commune", "code_departement",
                              "nature_mutation", "type_local")
                },
                "sale_raw",
            ),
            _figures(
                "mutations",
                {
                    "lignes_moyenne": "avg(n)",
                    "lignes_mediane": "quantile_disc(n, 0.5)",
                    "lignes_max": "max(n)",
                    "valeur_non_constante": "count(*) FILTER (nv > 1)",
                    "multi_disposition": "count(*) FILTER (nd > 1)",
                },
                "per_sale",
            ),
            _figures(
                "aberrations",
                {
                    "lignes": "count(*)",
                    "valeur_nulle": "count(*) FILTER (valeur_fonciere IS NULL)",
                    "valeur_zero_ou_negative": "count(*) FILTER (valeur_fonciere <= 0)",
                    "valeur_p1": "quantile_disc(valeur_fonciere, 0.01)",
                    "valeur_p50": "quantile_disc(valeur_fonciere, 0.5)",
                    "valeur_p99": "quantile_disc(valeur_fonciere, 0.99)",
                    "surface_nulle_ou_zero": f"count(*) FILTER ({_BUILT} AND "
                    "(surface_reelle_bati IS NULL OR surface_reelle_bati <= 0))",
                    "surface_p1": f"quantile_disc(surface_reelle_bati, 0.01) FILTER ({_BUILT})",
                    "surface_p50": f"quantile_disc(surface_reelle_bati, 0.5) FILTER ({_BUILT})",
                    "surface_p99": f"quantile_disc(surface_reelle_bati, 0.99) FILTER ({_BUILT})",
                    "sans_coordonnees": "count(*) FILTER (longitude IS NULL OR latitude IS NULL)",
                },
                "sale_raw",
            ),
            *[
                _figures(
                    "prix_m2",
                    {
                        f"{kind}_n": f"count(*) FILTER (type_local = '{kind}')",
                        f"{kind}_p25": f"quantile_disc(prix_m2, 0.25) FILTER (type_local = '{kind}')",
                        f"{kind}_mediane": f"quantile_disc(prix_m2, 0.5) FILTER (type_local = '{kind}')",
                        f"{kind}_p75": f"quantile_disc(prix_m2, 0.75) FILTER (type_local = '{kind}')",
                    },
                    "lone",
                )
                for kind in ("Maison", "Appartement")
            ],
            _figures(
                "geographie",
                {
                    "communes_actives": "count(*)",
                    "communes_x_types": "sum(nt)",
                    "communes_peu_actives": "count(*) FILTER (n < 5)",
                },
                "per_commune",
            ),
        ]
    ),
}


# --- sources and sinks -------------------------------------------------------

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_CUSTOMER_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CUSTOMER.split(", "))

ORACLE |= {
    "csv_round_trip": f"SELECT {_CUSTOMER_TEXT} FROM customer",
    "csv_gzip_scan": f"SELECT {_CUSTOMER_TEXT} FROM customer",
    "csv_semicolon_scan": """
        SELECT c_name AS nom, CAST(c_custkey AS VARCHAR) AS cle FROM customer
        WHERE c_custkey % 7 <> 0""",
    "csv_typed_scan": f"SELECT {_RAW.replace('annee, ', '')} FROM sale_raw",
    "json_lines_scan": f"SELECT {_CUSTOMER} FROM customer",
    "geojson_scan": f"""
        SELECT code_commune, nom_commune, {half_up(_AREA, 2)} AS surface_km2 FROM ref""",
    "feature_split_sink": "SELECT code_commune, nom_commune FROM ref",
    "parquet_partitioned_sink": f"SELECT {_CUSTOMER} FROM customer",
    "json_sink": """
        SELECT '{"c_custkey":' || c_custkey || ',"detail":{"nom":'
               || CASE WHEN c_custkey % 2 = 0 THEN '"' || c_name || '"' ELSE 'null' END
               || ',"c_nationkey":' || c_nationkey || '}}' AS ligne
        FROM customer""",
    "optional_table": "SELECT c_custkey, CAST(NULL AS DOUBLE) AS bonus FROM customer",
    "region_lookup": """
        SELECT d.code_departement, code_region, nom_region
        FROM dept_box AS d LEFT JOIN region_map AS r ON r.code_departement = d.code_departement""",
    "spatial_join_pairs": """
        SELECT code_commune, lon, lat FROM box JOIN stop
          ON lon BETWEEN min_x AND max_x AND lat BETWEEN min_y AND max_y""",
    "polygon_centroid": f"""
        SELECT code_commune, {half_up("(min_x + max_x) / 2")} AS lon,
               {half_up("(min_y + max_y) / 2")} AS lat FROM box""",
    "publish_latest": f"""
        SELECT {_IDS}, {rounded("prix_m2_median", *DIMENSIONS, "score_valeur", "gap",
                                "gap_pondere")} FROM score_view""",
    "publish_web": """
        SELECT CAST(1 AS INTEGER) AS schema_version, '2024-01-01' AS run_date,
               CAST(2024 AS INTEGER) AS year, 'runs/2024-01-01' AS base,
               (SELECT count(*) FROM base_commune) AS nb_communes,
               (SELECT count(*) FROM base_commune
                WHERE code_commune IN (SELECT code_commune FROM score_view))
                   AS nb_communes_scorees,
               (SELECT count(*) FROM meta) AS nb_communes_avis,
               (SELECT count(*) FROM published_zone) AS nb_iris,
               (SELECT count(gap_iris) FROM published_zone) AS nb_iris_scores""",
}



def _corners(digits: int | None = None, polygons=SHAPE) -> str:
    """Points of the shape in every box: code, polygon, ring, place, x, y."""
    shares = ", ".join(
        f"({p}, {r}, {i}, {x}e0, {y}e0)"
        for p, polygon in enumerate(polygons)
        for r, ring in enumerate(polygon)
        for i, (x, y) in enumerate(ring)
    )
    x, y = (f"min_{a} + f{a} * (max_{a} - min_{a})" for a in "xy")
    if digits is not None:
        x, y = half_up(f"({x})", digits), half_up(f"({y})", digits)
    return f"""SELECT code_commune, nom_commune, p, r, i, {x} AS x, {y} AS y
               FROM box, (VALUES {shares}) AS c(p, r, i, fx, fy)"""


def _sides(corners: str) -> str:
    return f"""SELECT * FROM (
                   SELECT *, lead(x) OVER ring AS x2, lead(y) OVER ring AS y2,
                          first_value(x) OVER ring AS x0, first_value(y) OVER ring AS y0
                   FROM ({corners}) AS corners
                   WINDOW ring AS (PARTITION BY code_commune, p, r ORDER BY i)) AS linked
               WHERE x2 IS NOT NULL"""


_CROSS = "((x - x0) * (y2 - y0) - (x2 - x0) * (y - y0))"
_BAND = (
    f"radians(x2 - x) * (2 + {authalic_sine('y', 'e0')} + {authalic_sine('y2', 'e0')}) "
    f"* {AUTHALIC_KM**2 / 2!r}"
)
STEPS["shape_side"] = _sides(_corners())
STEPS["rounded_side"] = _sides(_corners(3, SHAPE[:2]))  # the last part collapses


def _held(point: str, border: bool) -> str:
    """Even-odd test of point p by the sides s of a shape, its border apart."""
    px, py = f"{point}x", f"{point}y"
    inside = f"count(*) FILTER ((y > {py}) <> (y2 > {py}) AND {px} < x + ({py} - y) * (x2 - x) / (y2 - y)) % 2 = 1"
    touching = (
        f"bool_or((x2 - x) * ({py} - y) = (y2 - y) * ({px} - x) AND {px} BETWEEN least(x, x2) AND greatest(x, x2) "
        f"AND {py} BETWEEN least(y, y2) AND greatest(y, y2))"
    )
    return f"({touching} OR {inside})" if border else f"(NOT {touching} AND {inside})"


ORACLE |= {
    "shape_measures": f"""
        SELECT code_commune, {half_up("sum(CASE WHEN r = 0 THEN area ELSE -area END)", 5)} AS surface_km2,
               {half_up("sum(w * (x0 + mx / (a * 3))) / sum(w)", 5)} AS lon,
               {half_up("sum(w * (y0 + my / (a * 3))) / sum(w)", 5)} AS lat
        FROM (SELECT code_commune, r, min(x0) AS x0, min(y0) AS y0, abs(sum({_BAND})) AS area,
                     sum({_CROSS}) AS a, abs(sum({_CROSS})) * CASE WHEN r = 0 THEN 1 ELSE -1 END AS w,
                     sum((x + x2 - 2 * x0) * {_CROSS}) AS mx, sum((y + y2 - 2 * y0) * {_CROSS}) AS my
              FROM shape_side GROUP BY code_commune, p, r) AS rings
        GROUP BY code_commune""",
    "stops_in_shapes": f"""
        SELECT b.code_commune, count(h.code_commune) AS nb_arrets
        FROM box AS b LEFT JOIN (
            SELECT s.code_commune, px, py
            FROM (SELECT lon AS px, lat AS py FROM stop) AS q
            JOIN box AS o ON px BETWEEN min_x AND max_x AND py BETWEEN min_y AND max_y
            JOIN shape_side AS s ON s.code_commune = o.code_commune
            GROUP BY s.code_commune, px, py HAVING {_held("p", False)}) AS h
          ON h.code_commune = b.code_commune
        GROUP BY b.code_commune""",
    "sales_in_shapes": f"""
        SELECT id_mutation, s.code_commune
        FROM (SELECT id_mutation, code_commune, longitude AS px, latitude AS py FROM clipped) AS q
        JOIN shape_side AS s ON s.code_commune = q.code_commune
        GROUP BY id_mutation, s.code_commune HAVING {_held("p", True)}""",
    "shape_collections": f"""
        SELECT code_commune, nom_commune, CAST(2 AS INTEGER) AS parts, CAST(3 AS INTEGER) AS rings,
               CAST({sum(len(r) for p in SHAPE[:2] for r in p)} AS INTEGER) AS points,
               {half_up("sum(CASE WHEN r = 0 THEN area ELSE -area END)", 5)} AS surface_km2
        FROM (SELECT code_commune, nom_commune, r, abs(sum({_BAND})) AS area
              FROM rounded_side GROUP BY code_commune, nom_commune, p, r) AS rings
        GROUP BY code_commune, nom_commune""",
}

STEPS["published_zone"] = ORACLE["choropleth_zone"]

#: Artefact -> (query whose rows are its items, their key, column that splits it into documents).
_PUBLISHED = {
    "regions-low": ("choropleth_region", "code_region", None),
    "regions": ("choropleth_region", "code_region", None),
    "departements-low": ("choropleth_dept", "code_departement", None),
    "departements-mid": ("choropleth_dept", "code_departement", None),
    "communes-mid": ("choropleth_commune", "code_commune", None),
    "communes-high": ("choropleth_commune", "code_commune", "code_departement"),
    "iris-high": ("choropleth_zone", "code_iris", "code_departement"),
    "communes": ("territory_document", "code_commune", "code_departement"),
    "avis": ("review_export", "code_commune", "code_departement"),
    "avis-index": ("review_index", "c", None),
    "search": ("search_index", "c", None),
    "classement": ("ranking_top_n", "code_commune", None),
    "points": ("points_sample", "prix", None),
    "stats": ("territory_stats", "code_commune", None),
    "distribution": ("price_histogram", "bin", None),
    "series": ("price_series", "code_commune", None),
    "national": ("national_weighted_median", "annee", None),
    "score": ("score_flat", "code_commune", None),
}
ORACLE["published_artefacts"] = " UNION ALL ".join(
    f"""
        SELECT '{name}' AS artefact,
               {f"count(DISTINCT {split})" if split else "CAST(1 AS BIGINT)"} AS documents,
               count({"DISTINCT " + key if name == "series" else "*"}) AS items,
               CAST(min(CAST({key} AS VARCHAR)) AS VARCHAR) AS first,
               CAST(max(CAST({key} AS VARCHAR)) AS VARCHAR) AS last
        FROM ({ORACLE[rows]}) AS items"""
    for name, (rows, key, split) in _PUBLISHED.items()
).replace(
    f"({ORACLE['national_weighted_median']}) AS items",  # the run's own year comes on top
    f"(SELECT annee FROM ({ORACLE['national_weighted_median']}) UNION ALL SELECT 2024) AS items",
).replace(
    f"({ORACLE['price_series']}) AS items",
    f"(SELECT code_commune FROM ({ORACLE['price_series']}) "
    f"UNION ALL SELECT code_commune FROM price WHERE nb_transactions >= {RELIABLE_FROM}) AS items",
)
ORACLE["published_documents"] = f"""
        SELECT code_commune, nom_commune, code_departement AS departement, prix_median, n_avis,
               CAST(greatest(annees, 0) + CAST(NOT sans_prix AS INTEGER) AS INTEGER) AS annees
        FROM ({ORACLE["territory_document"]}) AS documents"""


for _name in ("clip_sales", "commune_agg", "dept_agg", "zone_prices", "price_histogram"):
    ORACLE[f"{_name}_ranked"] = ORACLE[_name]


def oracle_sql() -> dict[str, str]:
    """Complete statements, shared steps included."""
    return {name: with_clause(sql, STEPS) for name, sql in ORACLE.items()}
