import random

import corpus_pipeline
from jobloom.llm import pii
from jobloom.llm.common import find_words

STAGES = dict(corpus_pipeline.STAGES)


def sentence(r, n):
    return " ".join("".join(r.choice(["the", "ing", "and", "er", "tion"]) for _ in range(2)) for _ in range(n))


def raw():
    r = random.Random(8)
    rows = [(k, sentence(r, r.randint(10, 80)), r.choice(["en", "fr", None]), r.choice(["a", "b", "c", None])) for k in range(60)]
    rows += [(100 + k, rows[k][1], "en", "a") for k in range(10)] + [(100, rows[0][1], "en", "a")]
    return rows + [(200, None, "en", "a"), (201, "12 34", "en", "b"), (202, rows[5][1] + " mail a.b@c.org", "en", "b"), (3, "another the er", "en", "c")]


def rows_of(frame):
    return sorted(map(tuple, frame.select(*corpus_pipeline.COLUMNS).collect()), key=repr)


def test_stages(spark, documents):
    docs = documents(raw())
    found = STAGES["language"](spark, docs, "")
    assert found.columns == corpus_pipeline.COLUMNS
    kept = {(r["doc_id"], r["text"]) for r in found.collect()}
    assert kept == {(k, t) for k, t, *_ in raw() if t and any(c.isalpha() for c in t)}

    single = STAGES["near_duplicates"](spark, found, "")
    texts = [r["text"] for r in single.collect()]
    assert len(texts) == len(set(texts)) == len({t for _, t in kept}) - (raw()[5][1] + " mail a.b@c.org" not in texts)
    assert min(r["doc_id"] for r in single.where(single.text == raw()[0][1]).collect()) == 0

    clean = STAGES["personal_data"](spark, single, "")
    assert clean.count() == single.count()
    assert not any(pii.base_spans(r["text"]) for r in clean.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())

    mix = STAGES["mixing"](spark, clean, "")
    assert set(rows_of(mix)) <= set(rows_of(clean))
    words = sum(len(find_words(r["text"])) for r in clean.collect())
    assert abs(sum(len(find_words(r["text"])) for r in mix.collect()) - 1.5 * words) < 0.1 * words

    last = STAGES["bpe"](spark, mix, "")
    assert last.count() == mix.count()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in last.collect())


def test_stages_stand_alone(spark, documents):
    docs = documents([*raw(), (None, None, None, None), (None, "the er ing", None, None)])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() > 0, name
        assert stage(spark, docs.where("false"), "").count() == 0, name


def test_repeated_rows_are_kept_by_the_other_stages(spark, documents):
    docs = documents([(1, "the er ing tion and", "en", "a")] * 5)
    assert STAGES["language"](spark, docs, "").count() == 5
    assert STAGES["near_duplicates"](spark, docs, "").count() == 1
    assert STAGES["personal_data"](spark, docs, "").count() == 5
    assert STAGES["mixing"](spark, docs, "").count() in (7, 8)


def test_documents_stay_where_no_language_was_learnt_or_it_is_called_und(spark, documents):
    stage = dict(corpus_pipeline.STAGES)["language"]
    for lang in (None, "und"):
        rows = [(k, "some words" if k % 3 else "123", lang, "s") for k in range(12)]
        assert {r["doc_id"] for r in stage(spark, documents(rows), "").collect()} == {k for k in range(12) if k % 3}
