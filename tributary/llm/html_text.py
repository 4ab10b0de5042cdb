"""Main text of web pages by wrapper induction.

Pages of a host are mostly made from one template. The commonest shape of a host's pages is
taken for it, and all other shapes of the host are aligned with it by simple tree matching.
A place of the template whose text is the same on every page, whatever the page is about,
is template; places whose text varies are slots for content. Of these, parts that are no
article by their own words (menus, adverts, comments) are left out; see ``dom``.

Trees are aligned once for each shape of a host and not for each page, and what is known of
a place (least and greatest digest of its text) are sums with partial results, so a host
with a third of all pages is neither gathered anywhere nor sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tributary.llm.dom import page
from tributary.llm.tables import pick, skew_join, stored
from tributary.llm.tree_match import Match

_FACTS = "host string, shape_id long, shape string, title long, places array<int>, digests array<long>"
_TEXTS = (
    "page_id long, url string, host string, shape_id long, places array<int>, texts array<string>"
)


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; null if there is none."""
    name = F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(name != "", name)


def _hash(text: str) -> int:
    return xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shape and digests of the text at each place, without the texts."""
    for batch in batches:
        rows = []
        for name, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            read = page(html)
            texts: dict[int, list[str]] = {}
            for place, text, _ in read.blocks:
                texts.setdefault(place, []).append(text)
            rows.append(
                {
                    "host": name, "shape_id": _hash(read.shape), "shape": read.shape,
                    "title": _hash(read.title), "places": [*texts],
                    "digests": [_hash("\n".join(t)) for t in texts.values()],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, _schema_of(_FACTS))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that may belong to the article, with their places."""
    for batch in batches:
        rows = []
        for page_id, url, name, html in zip(*(c.to_pylist() for c in batch.columns)):
            read = page(html)
            kept = [(place, text) for place, text, inside in read.blocks if inside]
            rows.append(
                {
                    "page_id": page_id, "url": url, "host": name, "shape_id": _hash(read.shape),
                    "places": [place for place, _ in kept], "texts": [text for _, text in kept],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, _schema_of(_TEXTS))


def _schema_of(text: str) -> pa.Schema:
    kinds = {
        "string": pa.string(), "long": pa.int64(), "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in text.split(", "))])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, shape_id, place, ref): places of a shape and of its host's template."""
    match = Match()
    for batch in batches:
        hosts, ids, places, refs = [], [], [], []
        for name, shape_id, shape, template in zip(*(c.to_pylist() for c in batch.columns)):
            if len(match.known) > 100_000:
                match = Match()
            pairs = match.places(shape, template)
            hosts += [name] * len(pairs)
            ids += [shape_id] * len(pairs)
            places += [a for a, _ in pairs]
            refs += [b for _, b in pairs]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(ids, pa.int64()),
             pa.array(places, pa.int32()), pa.array(refs, pa.int32())],
            names=["host", "shape_id", "place", "ref"],
        )


def induce(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shapes of each host (host, shape_id, n) and their template places (host, shape_id,
    places), for shapes that have any.

    ``pages`` has url and html. A place is template if every page that has it, and its host
    has pages of two titles at least, says the same there.
    """
    facts = pick(pages, url="string", html="string").select(host(F.col("url")).alias("host"), "html")
    facts = stored(facts.where("host is not null").mapInArrow(_facts, _FACTS), "facts")
    shapes = stored(
        facts.groupBy("host", "shape_id", "shape").agg(F.count("*").alias("n")), "shapes"
    )
    most = shapes.groupBy("host").agg(F.max(F.struct("n", "shape_id")).alias("most"))
    template = most.select("host", F.col("most.shape_id").alias("shape_id")).join(
        shapes.select("host", "shape_id", F.col("shape").alias("template")), ["host", "shape_id"]
    )
    aligned = skew_join(shapes.select("host", "shape_id", "shape"), template.drop("shape_id"), "host")
    aligned = aligned.mapInArrow(_align, "host string, shape_id long, place int, ref int")
    places = (
        facts.select("host", "shape_id", "title", F.inline(F.arrays_zip("places", "digests")))
        .withColumnsRenamed({"places": "place", "digests": "digest"})
        .groupBy("host", "shape_id", "place")
        .agg(
            F.min("digest").alias("low"), F.max("digest").alias("high"),
            F.min("title").alias("first"), F.max("title").alias("last"),
        )
    )
    # Places without a partner in the template are judged among pages of their own shape.
    places = places.join(aligned, ["host", "shape_id", "place"], "left").withColumn(
        "slot",
        F.when(F.col("ref").isNull(), F.concat_ws(":", "shape_id", "place")).otherwise(
            F.col("ref").cast("string")
        ),
    )
    places = stored(places, "places")
    same = (
        places.groupBy("host", "slot")
        .agg(
            (F.min("low") == F.max("high")).alias("same"),
            (F.min("first") < F.max("last")).alias("apart"),
        )
        .where("same and apart")
        .select("host", "slot", F.lit(True).alias("template"))
    )
    fixed = skew_join(places.select("host", "shape_id", "place", "slot"), same, ["host", "slot"])
    fixed = (
        fixed.where("template").groupBy("host", "shape_id")
        .agg(F.collect_set("place").alias("template"))
    )
    return shapes.select("host", "shape_id", "n"), stored(fixed, "template")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page.

    Blocks are joined by line feeds in page order. A null page has an empty text. Pages
    without a host, and pages of hosts whose pages all bear one title, are read without a
    template; so are pages of which it would leave nothing: such pages are copies of one
    another. Rows that repeat are read each. Needs page_id, url and html; other columns are
    ignored.
    """
    shapes, template = induce(pages)
    rows = pick(pages, page_id="bigint", url="string", html="string").select(
        "page_id", "url", host(F.col("url")).alias("host"), "html"
    )
    rows = skew_join(
        rows.mapInArrow(_texts, _TEXTS), template, ["host", "shape_id"], counts=shapes
    )
    slots = F.transform(
        F.filter(
            F.arrays_zip("places", "texts"),
            lambda block: ~F.array_contains("template", block["places"]),
        ),
        lambda block: block["texts"],
    )
    rows = rows.withColumn("slots", F.when(F.col("template").isNotNull(), slots))
    kept = F.when(F.size("slots") > 0, F.col("slots")).otherwise(F.col("texts"))
    rows = rows.select("page_id", "url", F.array_join(kept, "\n").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))
