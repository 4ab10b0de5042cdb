"""Each query over the smallest tables, and the pipeline against its stages told plainly."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
import pytest
from samples import SF, docs, edge_rows, sentence  # noqa: F401  (docs is a fixture)
from tokenizers import Tokenizer

from tributary.llm import mixing, packing, personal, quality, queries, simhash

COLUMNS = {
    "op1": "doc_id n_bytes n_tokens over_limit",
    "op2": "doc_id held_out score predicted",
    "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4": "query_id rank vec_id score",
    "op5": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8": "doc_id fingerprint component_id",
    "op9": "doc_id size source_size target taken",
    "op10": "page_id payload_bytes payload_digest record_type refers_to",
    "op11": "page_id url text n_chars",
    "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        *COLUMNS
    ]


@pytest.mark.parametrize("name", [*queries.QUERIES])
def test_query(spark, name, texts):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name.split("_")[0]].split()
    rows = df.collect()
    if "doc_id" in df.columns:
        assert {r.doc_id for r in rows} == set(texts)
        if name != "op5_best_fit_packing":
            assert len(rows) == len(texts)
    else:
        assert rows


def test_pipeline(spark, texts):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.fit_rules(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    counts = np.array([quality.statistics(r["text"]) for r in texts.values()])
    kept = [r for r, bad in zip(texts.values(), rules.rejects(counts), strict=True) if not bad]
    assert 0 < len(kept) < len(texts)

    prints = [simhash.fingerprint(r["text"]) for r in kept]
    stay = []
    group: dict[int, int] = {}
    for i, p in enumerate(prints):  # components by spreading the smallest number
        group[i] = i
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    least: dict[int, dict] = {}
    for i, r in enumerate(kept):
        old = least.get(group[i])
        least[group[i]] = r if old is None or r["doc_id"] < old["doc_id"] else old
    stay = list(least.values())

    tagger = personal.fit_tagger(personal.labelled_table(spark))
    spans = personal.all_spans([r["text"] for r in stay], tagger)
    clean = [
        {**r, "text": personal.hidden(r["text"], own)} for r, (_, own) in zip(stay, spans, strict=True)
    ]
    assert any(a["text"] != b["text"] for a, b in zip(stay, clean, strict=True))

    schema = docs.select("doc_id", "text", "lang", "source", "n_chars").schema
    table = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in clean], schema)
    times = {r.doc_id: r.times for r in mixing.choose(table).collect()}

    out = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    wanted: Counter = Counter()
    for r in clean:
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        for i in range(0, len(ids), packing.LENGTH):
            wanted[r["doc_id"], i, ids[i : i + packing.LENGTH].tobytes()] += times[r["doc_id"]]
    assert Counter((r.doc_id, r.start, bytes(r.ids)) for r in out) == +wanted
    used = Counter()
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.LENGTH
    assert len(used) <= 1.05 * sum(used.values()) / packing.LENGTH + 1


def test_stages_on_edge_rows(spark, docs, tmp_path):
    """Nulls, empties, very long texts, ties, repeats, clashing columns; and no rows at all."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, f"{i} " + sentence(random.Random(i), 120) + f" {i}", "en", "a", 1) for i in range(20, 40)]
    table = docs([*edge_rows(), *rows], clash=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == table.columns, name
        found = out.collect()
        texts = [r[1] for r in found]
        if name == "quality_rules":  # all that is short goes; repeats stay together
            assert not {None, "", "ein"} & set(texts)
            assert sum(r[0] == 4 for r in found) in (0, 2)
        if name == "near_dedup":
            assert len(found) == len({(r[0], r[1]) for r in found})
            assert {r[0] for r in found} >= set(range(20, 40))
            assert sum(not (t or "").split() for t in texts) == 1
        if name == "pii":
            assert len(found) == len(rows) + len(edge_rows())
        if name == "mixing":
            assert found and all((t or "").split() for t in texts)
        upper = docs(rows).toDF("DOC_ID", "Text", "LANG", "Source", "n_Chars")
        assert stage(spark, upper, str(tmp_path)).columns == upper.columns
        none = docs([])
        assert stage(spark, none, str(tmp_path)).collect() == []
    packed = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).collect()
    assert sum(r.piece == 0 for r in packed) == len(rows) + len(edge_rows())
    assert corpus_pipeline.STAGES[-1][1](spark, docs([]), str(tmp_path)).collect() == []


def test_what_the_queries_add(spark, texts):
    """Columns that are made in the queries and not by the operators."""
    run = {name.split("_")[0]: rows for name, rows in ((n, q(spark, SF)) for n, q in queries.QUERIES.items()
           if n.split("_")[0] in ("op1", "op2", "op6", "op8", "op9"))}
    for r in run["op1"].collect():
        assert r.over_limit == (r.n_tokens > 2048) and r.n_bytes == len((texts[r.doc_id]["text"] or "").encode())
    for r in run["op2"].collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    for r in run["op6"].collect():
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        assert r["size"] == len((texts[r.doc_id]["text"] or "").encode()) + 1
    for r in run["op8"].collect():
        assert r.fingerprint == f"{simhash.fingerprint(texts[r.doc_id]['text']):016x}"
    taken, target, sizes = Counter(), {}, {}
    for r in run["op9"].collect():
        words = len((texts[r.doc_id]["text"] or "").encode().split())
        assert r["size"] == words and r.taken % max(words, 1) == 0 and r.taken <= 3 * words
        source = texts[r.doc_id]["source"]
        taken[source] += r.taken
        target[source] = r.target
        sizes.setdefault(source, []).append(words)
    for source, own in sizes.items():
        whole = sum(own)
        full = min(int(target[source] // whole), 3)
        reached = 1  # a bit for each sum of some documents
        for words in own:
            reached |= reached << words
        budget = min(round(target[source] - full * whole), whole)
        best = (reached & ((1 << budget + 1) - 1)).bit_length() - 1
        assert taken[source] == full * whole + best


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString()
