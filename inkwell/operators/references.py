"""Files of references: which of them stands for a paper, and what became of requests and writes about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators import picks

# Classes of files, and the evidence code of each method.
MAIN_TEXT = "converted_merged_main"
SUPPLEMENT_TEXT = "converted_merged_supplement"
EVIDENCE = {
    "abc_entity_extractor": "ECO:0008021",
    "abc_document_classifier": "ECO:0008004",
    "abc_literature_system": "ATP:0000036",
    "abc_string_matching_antibody": "ECO:0008021",
}


def listed(responses: DataFrame, key: str = "curie", files: str = "files") -> DataFrame:
    """key, seq (the place in the response) and the fields of each file; a null or empty response has none."""
    return responses.select(key, F.posexplode(files).alias("seq", "__file")).select(key, "seq", "__file.*")


def main_markdown(files: DataFrame, mod: str, key: str = "curie") -> DataFrame:
    """``files`` cut to one for each reference, with kind: its main Markdown (one in scope of ``mod`` first, else any), else a TEI in scope."""
    md = (F.col("file_extension") == "md") & (F.col("file_class") == MAIN_TEXT)
    tei = (F.col("file_extension") == "tei") & (F.col("file_class") == "tei") & picks.in_scope("referencefile_mods", mod)
    chosen = picks.prefer(files, [key], [md & picks.in_scope("referencefile_mods", mod), md, tei], ["seq"])
    return chosen.withColumn("kind", F.when(md, "md").otherwise("tei"))


def main_pdf(files: DataFrame, mod: str, key: str = "curie") -> DataFrame:
    """The final main PDF of each reference: the first that names ``mod``, else the first with a null mod."""
    pdf = (F.col("file_class") == "main") & (F.col("file_publication_status") == "final") & (F.col("file_extension") == "pdf")
    shared = F.coalesce(F.exists("referencefile_mods", lambda m: m["mod_abbreviation"].isNull()), F.lit(False))
    return picks.prefer(files.where(pdf), [key], [picks.strictly_in_scope("referencefile_mods", mod), shared], ["seq"])


def tei_files(files: DataFrame, mod: str, key: str = "curie") -> DataFrame:
    """The first TEI of each reference that names ``mod``; files of everyone don't count here."""
    own = (F.col("file_extension") == "tei") & picks.strictly_in_scope("referencefile_mods", mod)
    return picks.first_wins(files.where(own), [key], ["seq"])


def supplements(files: DataFrame, mod: str, key: str = "curie") -> DataFrame:
    """All Markdown supplements in scope, numbered from 1 in the order of the response."""
    own = (F.col("file_extension") == "md") & (F.col("file_class") == SUPPLEMENT_TEXT) & picks.in_scope("referencefile_mods", mod)
    return picks.numbered(files.where(own), [key], ["seq"])


def embedding_files(references: DataFrame, files: DataFrame, profile: str, version: int, key: str = "curie") -> DataFrame:
    """Each of ``references`` with file_id of its first embedding of that profile and version made from the main text, else null."""
    own = (F.col("file_class") == "embedding") & (F.col("profile_name") == profile) & (F.col("version") == version) & (F.col("source.file_class") == MAIN_TEXT)
    return references.join(picks.first_wins(files.where(own), [key], ["seq"]).select(key, "file_id"), key, "left")


def conversion_outcomes(polls: DataFrame, *, wait_for_supplements: bool = False, timeout: float = 1200.0, key: str = "curie") -> DataFrame:
    """key, outcome of polled conversion requests: the first poll that decides, else ``running``.

    ``polls``: seq, elapsed (seconds), http, status, converted_classes. A poll
    decides by an error code (failed), by its status (converted, failed,
    no_sources), by the main text's presence, unless supplements are waited
    for, or by being past the timeout; in this order.
    """
    ready = F.coalesce(F.array_contains("converted_classes", MAIN_TEXT), F.lit(False)) & F.lit(not wait_for_supplements)
    outcome = (
        F.when(~F.coalesce(F.col("http").isin(200, 202), F.lit(False)), "failed")
        .when(F.col("status").isin("converted", "failed", "no_sources"), F.col("status"))
        .when(ready, "converted")
        .when(F.col("elapsed") >= timeout, "timeout")
    )
    first = F.min(F.when(outcome.isNotNull(), F.struct("seq", outcome.alias("outcome"))))
    return polls.groupBy(key).agg(first.alias("__first")).select(key, F.coalesce("__first.outcome", F.lit("running")).alias("outcome"))


def evidence_code(method: Column) -> Column:
    """The evidence code of a method; an unknown method is an error."""
    known = F.create_map(*[F.lit(x) for pair in EVIDENCE.items() for x in pair])
    return F.coalesce(F.try_element_at(known, method), F.raise_error(F.concat(F.lit("no evidence code for method "), F.coalesce(method, F.lit("null")))).cast("string"))


def with_source_ids(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """method, mod, code, source_id, created: ids of tag sources, those that exist and new ones after the highest.

    One row for each method and mod, so the ranking window is as small as that.
    """
    coded = wanted.select("method", "mod").distinct().withColumn("code", evidence_code(F.col("method")))
    met = coded.join(existing.select("method", "mod", "source_id"), ["method", "mod"], "left")
    top = existing.agg(F.coalesce(F.max("source_id"), F.lit(0)).cast("long").alias("__top"))  # one row
    new = F.col("source_id").isNull()
    number = F.row_number().over(Window.partitionBy(new).orderBy("mod", "method"))
    numbered = met.crossJoin(F.broadcast(top)).withColumn("created", new).withColumn("source_id", F.coalesce("source_id", F.col("__top") + number))
    return numbered.select("method", "mod", "code", "source_id", "created")


def write_results(existing: DataFrame, rows: DataFrame, keys: list[str], *, present_is_success: bool) -> DataFrame:
    """keys, status, ok for each key to be written: ``created``, ``exists``, or ``invalid`` with a null in its key.

    What is there already counts as written for tags, and as refused for
    manual indexing; nothing is written or raised for a refused row.
    """
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    met = rows.select(*keys).distinct().join(existing.select(*keys).distinct().withColumn("__there", F.lit(True)), keys, "left")
    status = F.when(null, "invalid").when(F.col("__there"), "exists").otherwise("created")
    ok = (F.col("status") == "created") | ((F.col("status") == "exists") & F.lit(present_is_success))
    return met.withColumn("status", status).withColumn("ok", ok).select(*keys, "status", "ok")


def labelled_references(rows: DataFrame, xrefs: DataFrame, start: str | None = None) -> DataFrame:
    """curie, category of rows (seq, curie, xref, label), from the row of ``start`` on.

    A row without a curie takes that of its cross-reference (``xrefs``: xref,
    curie), and is passed over if there is none, or no label. Label "1" is
    positive, everything else negative. A ``start`` that never comes gives no row.
    """
    known = xrefs.select("xref", F.col("curie").alias("__curie"))
    met = rows.join(known, "xref", "left").withColumn("__own", F.coalesce(F.col("curie"), F.lit("")) != "")
    valid = met.where(F.col("__own") | (F.col("__curie").isNotNull() & (F.coalesce("label", F.lit("")) != "")))
    named = valid.withColumn("curie", F.when(F.col("__own"), F.col("curie")).otherwise(F.col("__curie")))
    if start is not None:
        cursor = named.where(F.col("curie") == start).agg(F.min("seq").alias("__from"))  # one row
        named = named.crossJoin(F.broadcast(cursor)).where(F.col("seq") >= F.col("__from"))
    return named.select("seq", "curie", F.when(F.col("label") == "1", "positive").otherwise("negative").alias("category"))
