"""The registered queries: their columns, their SQL twins, and the pipeline stage by stage."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from check import compare, connect

from tidewater.llm import mixture
from tidewater.llm.oracle import ORACLE
from tidewater.llm.queries import QUERIES

COLUMNS = {
    1: "doc_id text n_replaced",
    2: "doc_id n_shingles component_id kept",
    3: "doc_id start n_tokens ids_crc32",
    4: "doc_id held_out lang_pred score",
    5: "doc_id keep_id group_size kept text_sha256",
    6: "doc_id n_words n_base first_word last_word base_labels labels score",
    7: "doc_id size text_crc32 law shard slot grown_shard",
    8: "doc_id size source_size target taken",
    9: "doc_id held_out score predicted",
    10: "doc_id n_words n_hit n_items items_sha256 contaminated",
    11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    12: "doc_id held_out score predicted",
}


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_one_row_per_document(n, spark, sf, documents):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    out = QUERIES[name](spark, sf)
    assert set(COLUMNS[n].split()) <= set(out.columns)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in documents.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(name, spark, sf):
    ok, note = compare(spark, connect(sf), name, QUERIES[name], ORACLE[name], sf)
    assert ok, note


def test_pipeline(spark, sf, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["lang_id", "near_dups", "decontaminate", "mix", "shard"]
    docs = documents.cache()
    known = stages["lang_id"](spark, docs, sf).cache()
    assert known.columns == docs.columns and known.count() >= 0.99 * docs.count()
    one = stages["near_dups"](spark, known, sf).cache()
    keep = {d for d, v in brute.near([(r.doc_id, r.text) for r in known.collect()]).items() if v[2]}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == keep
    clean = stages["decontaminate"](spark, one, sf).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in one.collect()], items)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d, v in found.items() if not v[4]}
    mixed = stages["mix"](spark, clean, sf).cache()
    copies = {r.doc_id: r.copies for r in mixture.mixture(clean).collect()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in copies.items() if c})
    last = stages["shard"](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in mixed.collect())
    counts = Counter(r.shard for r in last)
    assert max(counts.values()) - min(counts[s] for s in range(24)) <= 1


def test_no_language_rejects(spark, sf, awkward):
    out = corpus_pipeline.identified(spark, awkward, sf)
    assert not {6, 7, 10, 14} & {r.doc_id for r in out.collect()}
