"""Readers of papers' files: Markdown, TEI and PMC XML, bib lines, logs, lists and tables of ids."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import intervals
from inkwell.operators.picks import first_wins


def text_of(content: Column) -> Column:
    """Bytes as UTF-8, or as Latin-1 where they aren't UTF-8."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, name, text of each file; the pattern is applied before anything is read."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return raw.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), text_of(F.col("content")).alias("text"))


def supplements(names: DataFrame) -> DataFrame:
    """``names`` (name) of supplements with stem, number (null if malformed) and ord, numbers first in their order."""
    from pyspark.sql import Window

    parts = names.withColumn("stem", F.regexp_extract("name", r"^(.*)\.supp_[^/]*\.md$", 1)).where("stem <> ''")
    number = F.try_to_number(F.nullif(F.regexp_extract("name", r"\.supp_(\d+)\.md$", 1), F.lit("")), F.lit("999999999")).cast("int")
    numbered = parts.withColumn("number", number)
    return numbered.withColumn("ord", F.row_number().over(Window.partitionBy("stem").orderBy(F.col("number").asc_nulls_last(), "name")))


HEADING = r"(?m)^#{1,6}\s+(.*?)\s*$"


def markdown_sections(papers: DataFrame, key: str = "name", text: str = "text") -> DataFrame:
    """key, ord, section, text: Markdown cut at headings; what stands before the first is section "". Section 0 is the title's."""
    marked = F.regexp_replace(F.col(text), HEADING, "\u0001$1\u0002")
    each = papers.select(key, F.posexplode(F.split(marked, "\u0001")).alias("ord", "__part"))
    head = F.split("__part", "\u0002")
    section, body = F.when(F.size(head) > 1, head[0]).otherwise(""), F.when(F.size(head) > 1, head[1]).otherwise(head[0])
    plain = F.trim(F.regexp_replace(F.regexp_replace(body, r"\*\*([^*]+)\*\*|\*([^*]+)\*|__([^_]+)__|`([^`]+)`", "$1$2$3$4"), r"\s+", " "))
    return each.select(key, "ord", F.regexp_replace(section, r"[*_`]", "").alias("section"), plain.alias("text"))


def fulltext(sections: DataFrame, key: str = "name", *, references: bool = False, order: tuple[str, ...] | None = None) -> DataFrame:
    """key, fulltext: sections in their order (or those of ``order`` first), without references unless asked for."""
    low = F.lower("section")
    kept = sections if references else sections.where(~low.isin("references", "bibliography"))
    place = F.col("ord")
    if order:
        place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), low), F.lit(0)), F.lit(1 << 20) + F.col("ord"))
    part = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct(place.cast("long").alias("o"), "ord", "text"))))
    return kept.groupBy(key).agg(F.array_join(F.transform(part, lambda s: s["text"]), " ").alias("fulltext"))


def page_only(tokens: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """key, token of those whose every position lies within a span of their document."""
    swept = intervals.covered(tokens.select(key, "token", "pos"), spans, key)
    return swept.groupBy(key, "token").agg(F.bool_and("inside").alias("all_inside")).where("all_inside").select(key, "token")


def bib(lines: DataFrame, line: str = "value") -> DataFrame:
    """``lines`` with field and value, split at the first pipe."""
    cut = F.split(line, r"\|", 2)
    return lines.withColumns({"field": F.trim(cut[0]), "content": F.trim(F.get(cut, F.lit(1)))}).where("content is not null")


def run_logs(logs: DataFrame) -> DataFrame:
    """filename, date and counters (a map) of each log's last run summary; logs without one are left out."""
    found = F.regexp_extract_all("text", F.lit(r"RUN SUMMARY: (\{.*\})"), F.lit(1))
    last = F.when(F.size(found) > 0, F.element_at(found, -1))
    counters = F.from_json(F.translate(last, "'", '"'), "map<string,bigint>")
    dated = F.regexp_extract("filename", r"_(\d{2})(\d{2})(\d{4})", 0)
    own = F.concat_ws("-", F.substring(dated, 6, 4), F.substring(dated, 2, 2), F.substring(dated, 4, 2))
    date = F.when(dated != "", own).otherwise(F.regexp_extract("text", r"(\d{4}-\d{2}-\d{2})", 1))
    return logs.select("filename", date.alias("date"), counters.alias("counters")).where("counters is not null")


def gene_synonyms(rows: DataFrame) -> DataFrame:
    """name, gene: synonyms with the symbol over its synonyms over the full name over its synonyms; the last row wins.

    ``rows``: seq, gene, symbol, fullname, fullname_synonyms, symbol_synonyms (the last two split by pipes).
    """
    listed = lambda c: F.split(F.coalesce(c, F.lit("")), r"\|")
    kinds = ((0, listed(F.col("fullname_synonyms"))), (1, F.array("fullname")), (2, listed(F.col("symbol_synonyms"))), (3, F.array("symbol")))

    def ranked(names: Column, priority: int) -> Column:
        return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(priority).alias("priority")))

    each = F.flatten(F.array(*[ranked(names, k) for k, names in kinds]))
    flat = rows.select("seq", "gene", F.explode(each).alias("e")).select("seq", "gene", "e.*").where("name is not null and name <> ''")
    return first_wins(flat, ["name"], [F.desc("priority"), F.desc("seq"), "gene"]).select("name", "gene")


def paired_ids(rows: DataFrame, key: str = "PMID", value: str = "PMCID", order: str | None = None) -> DataFrame:
    """key, value of the rows that have both; of several rows of a key the last one by ``order`` counts."""
    own = rows.select(F.trim(key).alias(key), F.trim(value).alias(value), *([order] if order else [])).where((F.col(key) != "") & (F.col(value) != ""))
    return first_wins(own, [key], [F.desc(order or value)]).select(key, value)


def dataset_entries(rows: DataFrame, curie: str = "curie", category: str = "classification") -> DataFrame:
    """curie, classification of a data set's lines: trimmed, the category in lower case; lines without either are left out."""
    own = rows.select(F.trim(curie).alias("curie"), F.lower(F.trim(category)).alias("classification"))
    return own.where("curie <> '' and classification <> ''").distinct()


def with_names(ids: DataFrame, names: DataFrame, key: str = "curie", name: str = "name") -> DataFrame:
    """``ids`` with the name of each, or the id itself; of several names the first in order counts."""
    known = names.groupBy(F.col(key).alias("__key")).agg(F.min(name).alias("__name"))
    return ids.join(known, F.col(key) == F.col("__key"), "left").select(*ids.columns, F.coalesce("__name", key).alias(name))


def curies(lines: DataFrame, prefix: str | None = None, line: str = "value") -> DataFrame:
    own = lines.select(F.trim(line).alias("curie")).where("curie <> ''")
    return own.where(F.col("curie").startswith(prefix)) if prefix else own


def word_vectors(lines: DataFrame, dim: int, line: str = "value") -> DataFrame:
    """word, vec of lines of a word and ``dim`` numbers; a header, lines of another length and lines with anything but numbers are left out."""
    parts = F.split(F.rtrim(line), " ")
    own = lines.select(parts.alias("__parts")).where(F.size("__parts") == dim + 1)
    vec = F.transform(F.slice("__parts", 2, dim), lambda x: x.try_cast("float"))
    return own.select(F.col("__parts")[0].alias("word"), vec.alias("vec")).where(~F.exists("vec", lambda x: x.isNull()))


def binary_vectors(files: DataFrame, content: str = "content") -> DataFrame:
    """word, idx, vec of files in word2vec's binary form, one of which a task holds at a time.

    A file is a line of the number of words and of the dimension, then for each
    word its bytes, a space and the little-endian floats, with or without a line
    end before the next. ``idx`` is a word's place in its file, from 0; a file
    that ends within a word has the words before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column("content"):
                words, vectors, dim = parsed_vectors(held.as_py() or b"")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * dim, pa.int32()), pa.array(vectors.ravel(), pa.float32()))
                for k in range(0, len(words), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(range(len(words)), pa.int64()), lists], names=["word", "idx", "vec"]).slice(k, 10_000)

    return files.select(F.col(content).alias("content")).mapInArrow(run, "word string, idx long, vec array<float>")


def parsed_vectors(data: bytes) -> tuple[list[str], np.ndarray, int]:
    head, _, _ = data.partition(b"\n")
    sizes = head.split()
    if len(sizes) != 2 or not all(x.isdigit() for x in sizes):
        return [], np.zeros((0, 0), dtype=np.float32), 0
    n, dim = map(int, sizes)
    words, found, at = [], [], len(head) + 1
    while len(words) < n:
        end = data.find(b" ", at)
        if end < 0 or end + 1 + 4 * dim > len(data):
            break
        words.append(data[at:end].lstrip(b"\n").decode(errors="replace"))
        found.append(np.frombuffer(data, dtype="<f4", count=dim, offset=end + 1))
        at = end + 1 + 4 * dim
    return words, np.array(found, dtype=np.float32).reshape(len(words), dim), dim


def as_binary_vectors(words: list[str], vectors: np.ndarray) -> bytes:
    """A file in word2vec's binary form; words have no spaces."""
    body = b"".join(w.encode() + b" " + v.astype("<f4").tobytes() + b"\n" for w, v in zip(words, vectors, strict=True))
    return b"%d %d\n" % vectors.shape + body


def entity_lists(rows: DataFrame, column: str) -> Column:
    """Upper-case entities of a column of pipe lists, without database prefixes."""
    return F.transform(F.split(column, r"\s*\|\s*"), lambda e: F.upper(F.regexp_replace(e, r"^.*;%;", "")))


def is_exception(candidate: str, exceptions: list[str]) -> bool:
    """Whether an exception stands in the candidate on letter and digit boundaries."""
    return any(re.search(rf"(?<![A-Za-z0-9]){re.escape(e)}(?![A-Za-z0-9])", candidate) for e in exceptions)


def italic_genes(xml: str, genes: dict[str, str], exceptions: list[str]) -> list[tuple[str, str, int, str]]:
    """(gene, candidate, relevant, snippet) for italic gene names; relevant: in the body, and not in its first section."""
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return []
    out = []

    def walk(node, body, section, parent) -> None:
        if node.tag == "body":
            body, section = node, None
        elif node.tag == "sec" and body is not None and section is None:
            section = node
        name = (node.text or "").strip()
        if node.tag == "italic" and len(name) > 1 and name in genes and not is_exception(name, exceptions):
            relevant = body is not None and not (section is not None and section is list(body)[0])
            out.append((genes[name], name, int(relevant), " ".join(parent.itertext()) if parent is not None else name))
        for child in node:
            walk(child, body, section, node)

    walk(root, None, None, None)
    return out


def gene_mentions(papers: DataFrame, genes: dict[str, str], exceptions: list[str], key: str, xml: str = "xml") -> DataFrame:
    """key, gene, n, of_genes (share of all mentions) and of_words, for mentions in relevant sections."""
    from pyspark.sql import Window

    kind = papers.schema[key].dataType.simpleString()
    shared = papers.sparkSession.sparkContext.broadcast((genes, exceptions))  # a curated list

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, g, x.count(" ") + 1) for k, x in zip(batch[key], batch[xml], strict=True) if x for g, _, relevant, _ in italic_genes(x, *shared.value) if relevant]
            yield pd.DataFrame(rows, columns=[key, "gene", "words"])

    each = papers.select(key, xml).mapInPandas(run, f"`{key}` {kind}, gene string, words long")
    counted = each.groupBy(key, "gene", "words").agg(F.count("*").alias("n"))
    return counted.select(key, "gene", "n", (F.col("n") / F.sum("n").over(Window.partitionBy(key))).alias("of_genes"), (F.col("n") / F.col("words")).alias("of_words"))
