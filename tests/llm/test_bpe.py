import hashlib
import random
import struct
import unicodedata

import pyarrow as pa
import pytest

from jobloom.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    found = tokenizers.Tokenizer.from_file(bpe.public_vocabulary())
    found.no_padding()
    found.no_truncation()
    return found


def odd_texts():
    r = random.Random(4)
    assigned = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = ["", "   ", "aaaaaaaaaaaaa", "ΑΣ Σ ΌΣΟΣ", "<|startoftext|>Hi<|endoftext|>there", "it's I'LL we'd 'S", "a\x1cb\x85c d", "ab" * 5000]
    texts += ["".join(chr(r.choice(assigned)) for _ in range(40)) for _ in range(300)]
    return texts + ["".join(r.choice("abAB '!<|>&sétñßÉ.12\n\t") for _ in range(60)) for _ in range(300)]


def test_ids_and_decoded_text_equal_the_library(reference):
    encoder = bpe.Encoder(bpe.vocabulary(bpe.public_vocabulary()))
    texts = odd_texts()
    for text, (ids, decoded) in zip(texts, encoder.encode(texts), strict=True):
        wanted = reference.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert decoded == reference.decode(wanted, skip_special_tokens=False)
        assert bpe.decode(ids.astype("<u4").tobytes(), encoder.vocab) == decoded


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(bpe.vocabulary(bpe.public_vocabulary()))
    texts = ["the cat sat on the mat", "another text of several words", "the cat again"]
    parts = [i.tolist() for t in texts for i, _ in encoder.encode([t])]
    assert parts == [i.tolist() for i, _ in bpe.Encoder(encoder.vocab).encode(texts)]


def test_result_of_the_query(documents, reference):
    texts = [None, "", "Hello world", "Hello world", "x" * 3000]
    frame = documents([(k, t, "en", "s") for k, t in enumerate(texts)])
    rows = {r["doc_id"]: r for r in bpe.encode_documents(frame).collect()}
    for k, text in enumerate(texts):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(frame.where("false")).count() == 0


def test_clashing_columns_are_replaced(spark):
    frame = spark.createDataFrame([("a b", "x", 1)], "text string, ids string, extra int")
    row = bpe.encode(frame, bpe.public_vocabulary()).first()
    assert row["extra"] == 1 and row["n_tokens"] == 2


def test_groups_of_texts_are_small(spark, monkeypatch):
    texts = pa.array([f"word{k} " * 1000 for k in range(200)])
    sizes = []
    whole = bpe.Encoder.encode
    monkeypatch.setattr(bpe.Encoder, "encode", lambda self, group: sizes.append(sum(map(len, group))) or whole(self, group))
    tasks = []
    frame = spark.createDataFrame([("a",)], "text string")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, of_task, schema: tasks.append(of_task))
    bpe.encode(frame, bpe.public_vocabulary())
    rows = sum(b.num_rows for b in tasks[0]([pa.RecordBatch.from_arrays([texts], ["text"])]))
    assert rows == 200 and max(sizes) < 550_000 < sum(sizes)
