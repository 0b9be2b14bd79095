"""Parsers of raw text: station sheets, review pages, keyed JSON, landed files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcella.functions.numbers import real_comma
from parcella.functions.text import title_case
from parcella.sources import readers, snapshots

# Layout of a station sheet.
COORDINATE_LINE = 3
VALUES_PER_ROW = 12
ROWS_AFTER_HEADING = 3

# Rating categories of a review page and their column names.
CATEGORIES = {
    "Environnement": "environnement",
    "Transports": "transports",
    "Sécurité": "securite",
    "Santé": "sante",
    "Sports et loisirs": "sports_et_loisirs",
    "Culture": "culture",
    "Enseignement": "enseignement",
    "Commerces": "commerces",
    "Qualité de vie": "qualite_de_vie",
}

# What the markup of a review page dictates.
REVIEW_OPENS = '<div class="comm"[^>]*>'
REVIEW_ENDS = ('<div id="pagination"', "</section>", "</main>")
RATING_CLASS = 'class="moyenne"'
DATE_AFTER, DATE_BEFORE = "Avis posté le ", " à"
AUTHOR_AFTER, AUTHOR_BEFORE = "Par <strong>", "</strong>"

_DMS = "{name}\\s*:\\s*(\\d+)°(\\d+)'(\\d+)\"([{plus}{minus}])"


def _degrees(line: Column, name: str, plus: str, minus: str) -> Column:
    """Degrees, minutes, seconds and hemisphere as decimal degrees (five decimals)."""
    pattern = _DMS.format(name=name, plus=plus, minus=minus)

    def part(i: int) -> Column:
        return F.regexp_extract(line, pattern, i)

    size = (
        part(1).try_cast("double")
        + part(2).try_cast("double") / 60
        + part(3).try_cast("double") / 3600
    )
    return F.round(F.when(part(4) == minus, -size).otherwise(size), 5)


def _last_of_row(lines: Column, heading: Column) -> Column:
    """Last number of the first full row within three lines of a heading.

    ``heading`` is the zero-based line number of the heading, or NULL.
    """
    after = F.slice(lines, heading + 2, ROWS_AFTER_HEADING)
    rows = F.transform(
        after,
        lambda line: F.filter(
            F.transform(F.split(line, ";"), lambda part: real_comma(part)),
            lambda number: number.isNotNull(),
        ),
    )
    full = F.filter(rows, lambda numbers: F.size(numbers) >= VALUES_PER_ROW)
    return F.try_element_at(F.get(full, F.lit(0)), F.lit(-1))


def _first_line(lines: Column, test) -> Column:
    hits = F.filter(
        F.transform(lines, lambda line, i: F.when(test(line), i)), lambda i: i.isNotNull()
    )
    return F.get(hits, F.lit(0))


def parse_station_sheets(sheets: DataFrame, station: str, text: str) -> DataFrame:
    """Station sheets (one text per row) to coordinates and yearly normals.

    Sheets without coordinates or sunshine are dropped; temperature is optional.
    """
    lines = F.split(F.col(text), "\n")
    header = F.get(lines, F.lit(COORDINATE_LINE))
    sunshine = _first_line(
        lines,
        lambda line: F.lower(line).contains("insolation") & F.lower(line).contains("heures"),
    )
    warmth = _first_line(lines, lambda line: line.contains("Température moyenne (Moyenne"))
    return sheets.select(
        F.col(station).alias("num_poste"),
        _degrees(header, "lat", "N", "S").alias("lat"),
        _degrees(header, "lon", "E", "W").alias("lon"),
        _last_of_row(lines, sunshine).alias("ensoleillement_h_an"),
        _last_of_row(lines, warmth).alias("temperature_moy_annuelle"),
    ).where(
        F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
        & F.col("ensoleillement_h_an").isNotNull()
    )


def between(c: Column, opening: str, closing: str) -> Column:
    """What stands after the first ``opening``, up to the next ``closing``; empty if neither."""
    after = F.get(F.split(c, f"\\Q{opening}\\E", 2), 1)
    return F.coalesce(F.substring_index(after, closing, 1), F.lit(""))


def without_tags(c: Column) -> Column:
    """Text of a fragment, a space for each tag, trimmed of all white space."""
    return F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "^\\s+|\\s+$", "")


def page_heading(html: Column | str) -> Column:
    """Text of the first heading, a trailing number in brackets left out."""
    page = F.col(html) if isinstance(html, str) else html
    return F.trim(F.regexp_replace(between(page, "<h1>", "</h1>"), "\\(\\d+\\)\\s*$", ""))


def page_title(html: Column | str) -> Column:
    """The heading in title case: the name of the place a page is about."""
    return title_case(page_heading(html))


def page_blocks(html: Column | str, opening: str, ends: Sequence[str]) -> Column:
    """Contents of every block from an opening tag (a pattern) to the next one or to the
    first of ``ends``. The last block of a page counts even when nothing follows it.
    """
    page = F.col(html) if isinstance(html, str) else html
    parts = F.split(page, opening)

    def cut(part: Column) -> Column:
        for end in ends:
            part = F.substring_index(part, end, 1)
        return part

    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), cut)


def extract_review_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Review pages to one row per rated review; blocks without a rating are skipped.

    ``pages`` needs ``slug``, ``code_commune``, ``nom_ville`` and the page text. Rows of
    the note table and labelled texts are cut at their tags; of two with the same name
    the last counts.
    """
    place = ["slug", "code_commune", "nom_ville"]
    blocks = page_blocks(html, REVIEW_OPENS, REVIEW_ENDS)
    block = F.col("_block")
    lines = F.split(between(block, "<table>", "</table>"), "</tr>")
    notes = F.transform(
        lines,
        lambda line: F.struct(
            F.trim(F.regexp_replace(between(line, "<th>", "</th>"), "<br />|\n", " ")).alias("name"),
            F.regexp_extract(between(line, "<td", "</td>"), ">(\\d+)$", 1).alias("note"),
        ),
    )
    bold = F.split(block, "<b>")
    texts = F.transform(
        F.slice(bold, F.lit(2), F.size(bold)),
        lambda part: F.struct(
            F.lower(F.substring_index(part, "</b>", 1)).alias("label"),
            without_tags(between(F.substring_index(part, "</p>", 1), "</b>", "<b>")).alias("body"),
        ),
    )
    mean = F.regexp_extract(
        F.substring_index(between(block, RATING_CLASS, "<"), ">", -1), "^[0-9.,]+", 0
    )
    read = (
        pages.select(*place, F.explode(blocks).alias("_block"))
        .select(
            *place,
            F.trim(between(block, DATE_AFTER, DATE_BEFORE)).alias("date"),
            F.trim(between(block, AUTHOR_AFTER, AUTHOR_BEFORE)).alias("auteur"),
            F.replace(mean, F.lit(","), F.lit(".")).alias("note_moyenne"),
            notes.alias("_notes"),
            texts.alias("_texts"),
        )
        .where("note_moyenne <> ''")
    )

    def last(found: Column, field: str) -> Column:
        return F.coalesce(F.try_element_at(found, F.lit(-1))[field], F.lit(""))

    def note(category: str) -> Column:
        return last(F.filter("_notes", lambda n: (n["name"] == category) & (n["note"] != "")), "note")

    def body(pattern: str) -> Column:
        return last(F.filter("_texts", lambda t: t["label"].rlike(pattern)), "body")

    return read.select(
        *place,
        "date",
        "auteur",
        "note_moyenne",
        *[note(category).alias(name) for category, name in CATEGORIES.items()],
        body("positif").alias("points_positifs"),
        body("n[ée]gatif").alias("points_negatifs"),
    )


def flatten_keyed_ratings(documents: DataFrame, text: str) -> DataFrame:
    """JSON objects keyed by slug to one flat row per slug.

    The commune code is what follows the last underscore of the slug.
    """
    names = {"name": "nom_ville", "postcode": "code_postal", "overall": "note_globale"}
    names |= {c: c for c in CATEGORIES.values()}
    value = ",".join(f"{n}:string" for n in names)
    entries = F.from_json(F.col(text), f"map<string,struct<{value}>>")
    code = F.regexp_extract("slug", "_([^_]*)$", 1)
    return documents.select(F.explode(entries).alias("slug", "_v")).select(
        "slug",
        code.alias("code_commune"),
        *[F.coalesce(F.col(f"_v.{n}"), F.lit("")).alias(out) for n, out in names.items()],
    )


def new_files(
    listing: DataFrame, landed: DataFrame | None, ingestion_date: str
) -> DataFrame:
    """Files whose landing key does not hold the same content yet.

    ``listing`` needs ``source``, ``dataset``, ``name``, ``content``; the result
    adds the content hash, the size, the key, which is partitioned by source,
    dataset and ingestion date, and the key's ``bucket`` in the ledger.
    """
    key = F.concat(
        F.lit("source="),
        "source",
        F.lit("/dataset="),
        "dataset",
        F.lit(f"/ingestion_date={ingestion_date}/"),
        "name",
    )
    hashed = listing.withColumns(
        {
            "sha256": F.sha2(F.col("content"), 256),
            "size_bytes": F.length(F.col("content").cast("binary")).cast("long"),
            "landing_key": key,
            "ingestion_date": F.lit(ingestion_date),
        }
    ).withColumn("bucket", F.substring(F.sha2("landing_key", 256), 1, 2))
    if landed is None:
        return hashed
    known = landed.select("landing_key", "sha256")
    return hashed.join(known, ["landing_key", "sha256"], "left_anti")


LEDGER = "landing string, landing_key string, sha256 string, size_bytes long, bucket string"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What was landed under ``path``: keys and hashes of every landing that was completed."""
    found = readers.optional_parquet(spark, f"{path}/ledger", LEDGER)
    return found.select("landing", "landing_key", "sha256", "size_bytes", "bucket")


def last_contents(entries: DataFrame) -> DataFrame:
    """The newest entry of each key; landings are named so that later ones sort last."""
    newest = F.max_by(F.struct("sha256", "size_bytes", "bucket"), "landing")
    return entries.groupBy("landing_key").agg(
        F.max("landing").alias("landing"), newest.alias("_last")
    ).select("landing_key", "landing", "_last.*")


def land_files(listing: DataFrame, path: str, ingestion_date: str) -> tuple[str, int]:
    """Append the files that are new under their key; the landing's name and their number.

    Contents go to ``data/landing=...``, then their keys and hashes to the ledger, as a
    folder that is renamed into it: a landing that dies before that left nothing that
    counts, and is simply done again. Hashes are held against the newest content of each
    key. The ledger is narrow and its own table, so contents are never read again.
    """
    spark = listing.sparkSession
    known = last_contents(ledger(spark, path))
    landing = f"{snapshots.ordinal(spark, f'{path}/ledger'):08d}-{uuid.uuid4().hex[:8]}"
    # stored before it is counted, so the ledger says what was written
    data = f"{path}/data/landing={landing}"
    new_files(listing, known, ingestion_date).withColumn(
        "ingested_at", F.current_timestamp()
    ).drop("bucket").write.partitionBy("source", "dataset", "ingestion_date").parquet(data)
    if not _has_rows(spark, data):
        return landing, 0
    written = spark.read.parquet(data).select("landing_key", "sha256", "size_bytes")
    entries = written.withColumn("bucket", F.substring(F.sha2("landing_key", 256), 1, 2))
    beside = f"{path}/entries-{landing}"
    entries.repartition("bucket").sortWithinPartitions("bucket", "landing_key").write.parquet(beside)
    snapshots.move(spark, beside, f"{path}/ledger/landing={landing}")
    return landing, entries.count()


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned write left any partition."""
    return snapshots.glob_count(spark, f"{path}/source=*") > 0


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """Newest content of every key, of completed landings only."""
    newest = last_contents(ledger(spark, path)).select("landing", "landing_key")
    return spark.read.parquet(f"{path}/data").join(newest, ["landing", "landing_key"])
