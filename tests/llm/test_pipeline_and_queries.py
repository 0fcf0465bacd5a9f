import pytest

import corpus_pipeline as P
from chatscope.llm import bpe, lang_id, quality_crf, queries, simhash
from chatscope.llm.common import crc32_mod, table
from tests.conftest import SF_SMALL
from tests.llm.test_bpe_packing import check_packing
from tests.llm.test_simhash import brute_components


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "quality_classifier", "simhash_near_dedup", "best_fit_packing"]


def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    langs = lang_id.train(docs.where(crc32_mod("doc_id", 4) != 2))
    left = [d for d, r in rows.items() if (p := langs.predict(r.text))[0] != "und" and p[1] >= lang_id.MIN_SCORE]
    kept = P.language_id(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(left)
    field = quality_crf.train(kept, table(spark, SF_SMALL, "labels").where(crc32_mod("doc_id", 5) != 0))
    left = [d for d in left if field.scores([rows[d].text])[0] >= 0.3]
    good = P.quality_classifier(spark, kept, SF_SMALL)
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == sorted(left)
    comp = brute_components(left, [simhash.fingerprint(rows[d].text) for d in left], 2)
    one = P.simhash_near_dedup(spark, good, SF_SMALL)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(set(comp))
    packed = P.run(spark, SF_SMALL).collect()
    assert {p.doc_id for p in packed} == set(comp)
    check_packing([rows[d] for d in set(comp)], packed, bpe.load_tokenizer(bpe.vocabulary_file()), 2048)


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    base = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "score", "component_id")
    for name, stage in P.STAGES[:-1]:
        for df in (base, base.limit(0)):
            out = stage(spark, df, SF_SMALL)
            assert out.columns == df.columns, name
            out.collect()
    assert P.best_fit_packing(spark, no_docs, SF_SMALL).collect() == []


CONTRACT = {  # query -> its first columns
    "op1_": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_": "doc_id fingerprint component_id", "op5_": "page_id host path rule verdict",
    "op6_": "doc_id held_out score predicted", "op7_": "page_id payload_bytes payload_digest record_type refers_to",
    "op8_": "doc_id n_tokens ids_sha256 decoded_sha256", "op9_": "doc_id n_words log_prob mean_log_prob",
    "op10_": "doc_id held_out lang_pred score",
    "op11_": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_": "doc_id start n_tokens ids_crc32"}


def test_collocation_columns(spark):
    df = queries.QUERIES["op13_collocations"](spark, SF_SMALL)
    assert df.columns == "lang rank phrase a l r n score".split() and df.count() > 0


@pytest.mark.parametrize("prefix", list(CONTRACT))
def test_contract_columns_and_rows(spark, prefix):
    (name,) = [n for n in queries.QUERIES if n.startswith(prefix)]
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.columns == CONTRACT[prefix].split()
    source = table(spark, SF_SMALL, "pages" if df.columns[0] == "page_id" else "documents")
    ids = [r[0] for r in df.select(df.columns[0]).distinct().collect()]
    assert sorted(ids) == sorted(r[0] for r in source.select(df.columns[0]).distinct().collect())
