"""Input views: the raw files of the pipeline, expressed over the test tables.

The SQL below uses only what Spark and ANSI engines share, so that one text
serves both the Spark queries and their checks. Geometry is added on the Spark
side from the box columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcella.functions import geo
from parcella.functions.regions import region_rows

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FACTS = ("lineitem", "documents")

_COMMUNE = "lpad(CAST({n} AS STRING), 2, '0') || lpad(CAST({k} AS STRING), 3, '0')"
_X = "(-5e0 + ({n} % 5) * 2.8e0 + ({k}) * 0.35e0)"
_Y = "(42e0 + (({n} - {n} % 5) / 5e0) * 1.8e0 + ({v}) * 1.8e0)"
_U = "({id} * 7919 % 1000) / 1000e0"
_V = "({id} * 104729 % 1000) / 1000e0"


def _commune(n: str = "c_nationkey", k: str = "c_custkey % 8") -> str:
    return _COMMUNE.format(n=n, k=k)


def _x(n: str, k: str) -> str:
    return _X.format(n=n, k=k)


def _y(n: str, v: str) -> str:
    return _Y.format(n=n, v=v)


_REGION_VALUES = ", ".join(
    "('{}', '{}', '{}')".format(d, c, name.replace("'", "''")) for d, c, name in region_rows()
)

VIEWS = {
    "sale_raw": f"""
        SELECT CAST(l_orderkey AS STRING) AS id_mutation,
               CAST(l_linenumber AS STRING) AS numero_disposition,
               CASE WHEN o_orderstatus = 'P' THEN 'Autre' ELSE 'Vente' END AS nature_mutation,
               CASE WHEN l_linestatus = 'O' THEN 'Maison' ELSE 'Appartement' END AS type_local,
               o_totalprice AS valeur_fonciere,
               l_quantity AS surface_reelle_bati,
               {_commune()} AS code_commune,
               n_name AS nom_commune,
               lpad(CAST(c_nationkey AS STRING), 2, '0') AS code_departement,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_mutation,
               CAST(year(o_orderdate) AS INT) AS annee,
               {_x("c_nationkey", "(c_custkey % 8) + " + _U.format(id="l_orderkey"))} AS longitude,
               {_y("c_nationkey", _V.format(id="l_orderkey"))} AS latitude
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "box": f"""
        SELECT {_commune("n", "k")} AS code_commune,
               lpad(CAST(n AS STRING), 2, '0') AS code_departement,
               n_name AS nom_commune, n, k,
               {_x("n", "k")} AS min_x, {_x("n", "k + 1")} AS max_x,
               {_x("n", "k + 0.5e0")} AS mid_x,
               {_y("n", "0e0")} AS min_y, {_y("n", "1e0")} AS max_y
        FROM (SELECT DISTINCT c_nationkey AS n, c_custkey % 8 AS k FROM customer) AS places
        JOIN nation ON n = n_nationkey""",
    "zone_box": """
        SELECT code_commune || '0000' AS code_iris, code_commune, nom_commune,
               'Centre' AS nom_iris, 'Z' AS type_iris, min_x, max_x, min_y, max_y
        FROM box WHERE k < 4
        UNION ALL
        SELECT code_commune || '0101', code_commune, nom_commune, 'Ouest', 'H',
               min_x, mid_x, min_y, max_y
        FROM box WHERE k >= 4
        UNION ALL
        SELECT code_commune || '0102', code_commune, nom_commune, 'Est', 'H',
               mid_x, max_x, min_y, max_y
        FROM box WHERE k >= 4""",
    "station_raw": f"""
        SELECT CAST(s_suppkey AS STRING) AS num_poste,
               -5e0 + 14e0 * ({_U.format(id="s_suppkey")}) AS lon,
               42e0 + 9e0 * ({_V.format(id="s_suppkey")}) AS lat,
               1000e0 + abs(s_acctbal) % 2000e0 AS ensoleillement_h_an,
               5e0 + (s_suppkey % 100) / 10e0 AS temperature_moy_annuelle
        FROM supplier""",
    "city_raw": f"""
        SELECT CAST(c_custkey AS STRING) AS code_insee,
               ' Ville ' || CAST(c_custkey AS STRING) AS nom_standard,
               CASE WHEN c_custkey % 3 = 0 THEN '1000'
                    ELSE CAST(50000 + c_custkey AS STRING) END AS population,
               {_x("c_nationkey", "(c_custkey % 8) + " + _U.format(id="c_custkey"))}
                   AS longitude_centre,
               {_y("c_nationkey", _V.format(id="c_custkey"))} AS latitude_centre
        FROM customer""",
    "stop_raw": f"""
        SELECT -5e0 + 14e0 * ({_U.format(id="event_id")}) AS stop_lon,
               42e0 + 9e0 * ({_V.format(id="event_id")}) AS stop_lat
        FROM events""",
    "household": f"""
        SELECT {_commune()} AS code, count(*) AS households,
               CAST(sum(c_custkey % 997) AS BIGINT) AS s
        FROM customer GROUP BY {_commune()}""",
    "income_raw": """
        SELECT code, 'Commune ' || code AS label,
               CASE WHEN s % 10 = 0 THEN 's' ELSE
                   CAST(CAST(4000 + (s % 80000) * 1.01e0 AS DECIMAL(18, 2)) AS STRING) END
                   AS median_text,
               CAST(CAST(3000 + s % 60000 AS DECIMAL(18, 2)) AS STRING) AS q1_text
        FROM household""",
    "rate_raw": f"""
        SELECT {_commune()} AS "CODGEO_2025",
               CAST(year(o_orderdate) AS STRING) AS annee,
               CASE WHEN o_orderstatus <> 'P' THEN 'diff' ELSE 'ndiff' END AS est_diffuse,
               replace(CAST(CAST(o_totalprice / 100000e0 AS DECIMAL(18, 7)) AS STRING),
                       '.', ',') AS taux_pour_mille,
               CAST(1000 + o_custkey % 5000 AS STRING) AS insee_pop
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "facility_raw": f"""
        SELECT {_commune()} AS "GEO",
               CASE WHEN l_linenumber < 6 THEN 'COM' ELSE 'IRIS' END AS "GEO_OBJECT",
               substr('ABCDEFG', CAST(p_size % 7 + 1 AS INT), 1) AS "FACILITY_DOM",
               CAST(l_quantity AS STRING) AS "OBS_VALUE"
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "risk_raw": f"""
        SELECT {_commune("user_id % 26", "user_id % 8")} AS code_commune,
               CASE event_type WHEN 'error' THEN 'Inondations et coulées de boue'
                               WHEN 'view' THEN 'Coulée de boue'
                               ELSE event_type END AS lib_risque_jo
        FROM events""",
    "label_raw": f"""
        SELECT {_commune()} AS code_insee_ban,
               ' ' || lower(substr('ABCDEFGHI', CAST(p_size % 9 + 1 AS INT), 1)) AS etiquette_dpe
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "housing_raw": f"""
        SELECT {_commune()} AS "COM",
               CAST(l_quantity AS STRING) AS "P21_LOG",
               CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0e0 END AS STRING)
                   AS "P21_RSECOCC"
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "job_raw": """
        SELECT code AS "CODGEO",
               CAST(1 + s % 900 + 0.5e0 AS STRING) AS "P21_ACT1564",
               CAST((1 + s % 900 + 0.5e0) * (s % 30) / 100e0 AS STRING) AS "P21_CHOM1564",
               CAST((1 + s % 900 + 0.5e0) * (s % 200) / 100e0 AS STRING) AS "P21_EMPLT"
        FROM household""",
    "review_raw": """
        SELECT d.doc_id, source AS slug,
               CAST(CAST(substr(source, 4) AS INT) AS STRING)
                   || lpad(CAST(CAST(substr(source, 4) AS INT) % 8 AS STRING), 3, '0')
                   AS code_commune,
               'Ville ' || source AS nom_ville,
               CASE WHEN d.doc_id % 17 = 0 THEN ''
                    ELSE lpad(CAST(1 + d.doc_id % 28 AS STRING), 2, '0') || '-'
                      || lpad(CAST(1 + d.doc_id % 12 AS STRING), 2, '0') || '-'
                      || CAST(2020 + d.doc_id % 4 AS STRING) END AS date,
               'auteur ' || CAST(d.doc_id % 50 AS STRING) AS auteur,
               CASE WHEN d.doc_id % 13 = 0 THEN ''
                    ELSE replace(CAST((d.doc_id % 101) / 10e0 AS STRING), '.', ',') END
                   AS note_moyenne,
               CAST(d.doc_id % 11 AS STRING) AS environnement,
               CASE WHEN d.doc_id % 3 = 0
                        THEN substr(text, 1, CAST((length(text) - length(text) % 2) / 2 AS INT))
                    WHEN coalesce(quality, d.doc_id % 2) = 1 THEN text ELSE '' END
                   AS points_positifs,
               CASE WHEN d.doc_id % 3 = 0
                        THEN substr(text, CAST((length(text) - length(text) % 2) / 2 AS INT) + 1)
                    WHEN coalesce(quality, d.doc_id % 2) = 1 THEN '' ELSE text END
                   AS points_negatifs
        FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id""",
    "sheet_raw": """
        SELECT CAST(s_suppkey AS STRING) AS num_poste,
               'FICHE CLIMATOLOGIQUE' || chr(10) || 'Statistiques' || chr(10) || s_name || chr(10)
               || 'alt : 250m lat : ' || CAST(42 + s_suppkey % 9 AS STRING) || '°'
               || lpad(CAST(s_suppkey % 60 AS STRING), 2, '0') || chr(39)
               || lpad(CAST(s_suppkey * 7 % 60 AS STRING), 2, '0') || chr(34)
               || CASE WHEN s_suppkey % 4 = 0 THEN 'S' ELSE 'N' END
               || ' lon : ' || lpad(CAST(s_suppkey % 7 AS STRING), 2, '0') || '°'
               || lpad(CAST(s_suppkey * 11 % 60 AS STRING), 2, '0') || chr(39)
               || lpad(CAST(s_suppkey * 13 % 60 AS STRING), 2, '0') || chr(34)
               || CASE WHEN s_suppkey % 2 = 0 THEN 'W' ELSE 'E' END
               || chr(10) || chr(10) || 'Insolation totale (heures)' || chr(10)
               || CASE WHEN s_suppkey % 5 = 0 THEN ' 100,0;101,0'
                       ELSE repeat(' 100,0;', 12) || CAST(1500 + s_suppkey % 900 AS STRING) || ',5'
                  END
               || chr(10) || chr(10) || 'Température moyenne (Moyenne en °C)' || chr(10)
               || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'janv;fevr' || chr(10) END
               || repeat('1,0;', 12) || CAST(8 + s_suppkey % 9 AS STRING) || ',9' AS sheet
        FROM supplier""",
    "region_map": f"""
        SELECT * FROM (VALUES {_REGION_VALUES})
            AS v(code_departement, code_region, nom_region)""",
    "region_box": """
        SELECT coalesce(code_region, 'Z' || b.code_departement) AS code_region,
               coalesce(min(nom_region), 'Hors région') AS nom_region,
               min(min_x) AS min_x, max(max_x) AS max_x, min(min_y) AS min_y, max(max_y) AS max_y
        FROM box AS b LEFT JOIN region_map AS r ON b.code_departement = r.code_departement
        GROUP BY coalesce(code_region, 'Z' || b.code_departement)""",
    "dept_box": """
        SELECT code_departement, min(nom_commune) AS nom_departement,
               min(min_x) AS min_x, max(max_x) AS max_x, min(min_y) AS min_y, max(max_y) AS max_y
        FROM box GROUP BY code_departement""",
    # Territory scores for the export queries, derived from per-commune sums. One
    # place in eight is renamed out of the outlines, so that scored communes
    # without outline exist; one in eight has no score at all.
    "score_view": f"""
        SELECT code_commune, 'Score ' || code_commune AS nom_commune, code_departement,
               nb_transactions, prix_m2_median,
               substr('ABCDEFG', CAST(s % 7 + 1 AS INT), 1) AS dpe_dominant,
               (s * 3 % 1000) / 1000e0 AS n_prix, (s * 7 % 1000) / 1000e0 AS n_transport,
               (s * 11 % 1000) / 1000e0 AS n_access_fin, (s * 13 % 1000) / 1000e0 AS n_risques,
               (s * 17 % 1000) / 1000e0 AS n_tourisme, (s * 19 % 1000) / 1000e0 AS n_securite,
               (s * 23 % 1000) / 1000e0 AS n_services, (s * 29 % 1000) / 1000e0 AS n_loisirs,
               (s * 31 % 1000) / 1000e0 AS n_ensoleillement, (s * 37 % 1000) / 1000e0 AS n_emploi,
               (s * 41 % 1000) / 1000e0 AS n_proximite, (s * 43 % 1000) / 1000e0 AS n_dpe,
               (s * 47 % 1000) / 1000e0 AS score_valeur,
               (s * 47 % 1000) / 1000e0 - (s * 3 % 1000) / 1000e0 AS gap,
               ((s * 47 % 1000) / 1000e0 - (s * 3 % 1000) / 1000e0)
                   * ((s * 11 % 1000) / 1000e0) AS gap_pondere
        FROM (SELECT CASE WHEN c_custkey % 8 = 7
                          THEN lpad(CAST(c_nationkey AS STRING), 2, '0') || '999'
                          ELSE {_commune()} END AS code_commune,
                     lpad(CAST(c_nationkey AS STRING), 2, '0') AS code_departement,
                     count(*) AS nb_transactions,
                     CAST(1000 + sum(c_custkey) % 4000 AS DOUBLE) AS prix_m2_median,
                     CAST(sum(c_custkey) AS BIGINT) AS s
              FROM customer
              GROUP BY c_nationkey, c_custkey % 8) AS sums""",
}


def mentioned(sql: str) -> list[str]:
    """Names a statement reads from."""
    return re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql)


def with_clause(sql: str, texts: dict[str, str]) -> str:
    """Prefix ``sql`` with the views it mentions, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in mentioned(text):
            if name in texts and name not in needed:
                visit(texts[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    body = ",\n".join(f"{name} AS ({texts[name]})" for name in needed)
    return f"WITH {body}\n{sql}"


# Schema and number of scan tasks per path, looked up once.
_SOURCES: dict[str, tuple[StructType, int]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables.

    A fact table that arrives in fewer pieces than there are cores (here each
    file is one row group) is spread out; a large one is read as it is.
    """
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SOURCES:
        found = spark.read.parquet(path)
        _SOURCES[path] = (found.schema, found.rdd.getNumPartitions())
    schema, tasks = _SOURCES[path]
    frame = spark.read.schema(schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return frame.repartition(cores) if name in FACTS and tasks < cores else frame


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``VIEWS`` over the tables in ``sf_dir``."""
    sql = with_clause(f"SELECT * FROM {name}", VIEWS)
    for t in set(mentioned(sql)) & set(TABLES):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql.replace('"', "`"))


def with_box(df: DataFrame, *, drop: bool = True) -> DataFrame:
    """Turn the box columns into a ``geom`` multipolygon."""
    corners = ("min_x", "min_y", "max_x", "max_y")
    shaped = df.withColumn("geom", geo.box(*[F.col(c) for c in corners]))
    extra = [c for c in (*corners, "mid_x", "n", "k") if c in df.columns]
    return shaped.drop(*extra) if drop else shaped


#: A concave outline with a hole, an island and a part that vanishes when rounded: polygons of
#: rings of points, in shares of a box. Queries place it in every box, their SQL twins too.
SHAPE = (
    (
        ((0.0, 0.0), (1.0, 0.0), (1.0, 0.4), (0.45, 0.4), (0.45, 1.0), (0.0, 1.0), (0.0, 0.0)),
        ((0.1, 0.1), (0.1, 0.3), (0.35, 0.2), (0.1, 0.1)),
    ),
    (((0.6, 0.6), (0.9, 0.55), (0.95, 0.9), (0.7, 0.95), (0.6, 0.6)),),
    (((0.5, 0.5), (0.50001, 0.5), (0.50001, 0.50001), (0.5, 0.5)),),
)


def with_shape(df: DataFrame) -> DataFrame:
    """Turn the box columns into the multipolygon ``SHAPE`` inside the box."""

    def at(share: float, axis: str) -> Column:
        low, high = F.col(f"min_{axis}"), F.col(f"max_{axis}")
        return low + F.lit(share) * (high - low)

    rings = [
        F.array(*[F.array(*[F.array(at(x, "x"), at(y, "y")) for x, y in ring]) for ring in polygon])
        for polygon in SHAPE
    ]
    return df.withColumn("geom", F.array(*rings))
