"""The pipeline against the operators' results by hand, stage by stage."""

import re

import numpy as np
import pytest
from documents_by_hand import FOLDER, awkward, given
from test_duplicates import near_by_hand
from test_encoding import encoded, little
from test_text_models import shingles_by_hand, spans_by_hand

import corpus_pipeline
from starloom.llm.stored import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(rows before, rows after) of each stage, on the given documents."""
    docs, out = given(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, FOLDER), name)
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def test_all_but_the_last_keep_the_columns(stages):
    for name, (before, _) in stages.items():
        assert sorted(before[0].asDict()) == sorted(COLUMNS), name


def test_quality_keeps_clean_documents(spark, stages):
    before, after = stages["quality"]
    label = {r.doc_id: r for r in given(spark, "labels").collect()}
    kept = {r.doc_id for r in after}
    clean = [r.doc_id in kept for r in before if r.doc_id in label and label[r.doc_id].quality == 1 and label[r.doc_id].toxic == 0]
    bad = [r.doc_id in kept for r in before if r.doc_id in label and label[r.doc_id].quality == 0]
    assert np.mean(clean) > 0.95 and np.mean(bad) < 0.2
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    wanted = {c for _, _, c in near_by_hand([(r.doc_id, r.text) for r in before], 5)}
    assert sorted(r.doc_id for r in after) == sorted(wanted)


def test_documents_with_benchmark_items_go(spark, stages):
    before, after = stages["benchmark"]
    items = [shingles_by_hand(r.text) for r in given(spark, "benchmark").collect()]
    held = {r.doc_id for r in before if any(len(s & own) >= 0.8 * len(s) for own in [shingles_by_hand(r.text)] for s in items)}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in held)


def test_secrets_are_marked(stages):
    before, after = stages["secrets"]
    text = {r.doc_id: r for r in after}
    assert len(text) == len(before)
    for r in before:
        wanted, at = "", 0
        for _, a, b in spans_by_hand(r.text):
            if a >= at:
                wanted += r.text[at:a] + "[secret]"
            at = max(at, b)
        assert text[r.doc_id].text == wanted + r.text[at:]
        assert text[r.doc_id].n_chars == len(text[r.doc_id].text)
        assert not re.search(r"AKIA[A-Z0-9]{14}", text[r.doc_id].text)


def test_ids_are_the_library_s(stages):
    before, after = stages["bpe"]
    wanted = {r.doc_id: little(ids) for r, ids in zip(before, encoded([r.text for r in before]))}
    assert {r.doc_id: bytes(r.ids) for r in after} == wanted


def test_awkward_documents(spark):
    docs = awkward(spark).select(*COLUMNS)
    for stage in (docs, docs.limit(0)):
        out = stage
        for name, step in corpus_pipeline.STAGES:
            out = stored(step(spark, out, FOLDER), name)
        assert out.columns == ["doc_id", "n_tokens", "ids"]
    repeated = stored(docs.where("doc_id = 8"), "repeated")
    assert corpus_pipeline.without_copies(spark, repeated, FOLDER).count() == 1
