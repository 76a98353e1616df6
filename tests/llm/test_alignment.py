import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobloom.llm import alignment

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.public_vocabularies()


def plain(texts, vocabularies):
    """The result of the query by loops over whole texts."""
    left = tokenizers.Tokenizer.from_str(vocabularies.byte_level)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces)
    of_char = alignment.byte_characters()
    rows, linked = [], []
    for text in texts:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        a_bytes = [bytes(of_char[c] for c in left.id_to_token(k)) for k in a]
        b_bytes = [bytes([int(right.id_to_piece(k)[3:5], 16)]) if right.is_byte(k) else right.id_to_piece(k).replace("▁", " ").encode() for k in b]
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end, b_end, at = {}, {}, 0
        for k, x in enumerate(a_bytes):
            at += len(x)
            a_end[at] = k
        at = 0
        for k, x in enumerate(b_bytes):
            at += len(x)
            b_end[at] = k
        common = sorted(set(a_end) & set(b_end))
        i = j = 0
        groups = []
        for end in common:
            groups.append(",".join(map(str, a[i : a_end[end] + 1])) + "|" + ",".join(map(str, b[j : b_end[end] + 1])))
            i, j = a_end[end] + 1, b_end[end] + 1
        linked.append([(a[a_end[e]], b[b_end[e]]) for e in common])
        joined = ";".join(groups)
        rows.append([len(a), len(b), len(groups), len(common), hashlib.sha256(joined.encode()).hexdigest() if joined else ""])
    count = Counter(p for pairs in linked for p in pairs)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    for row, pairs in zip(rows, linked, strict=True):
        row[4:4] = [sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs)]
    return [tuple(r) for r in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd_texts():
    r = random.Random(2)
    texts = [
        None, "", " ", "   ", "a", " a", "a ", "a  b", "  a  b ", "\n", "a\n b", "a \n b", "a\tb \t c", "x  y", "a\x85 b", "a\x1c b", "one▁two three",
        "<|endoftext|> and <|endoftext|>", "it's I'll we'd '  's", "<0x41> <s> </s> <unk>", "🙂 🙃🙂", "a\0b", "word " * 3000, "x" * 4000, "naïve café 東京 タワー",
    ]
    letters = "abcde  \n\t.,'é▁🙂1 "
    return texts + ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(300)] + ["a b", "a b"]


@pytest.mark.parametrize("share", [alignment.COMMON_SHARE, 0.01, 2.0])
def test_equals_loops_over_whole_texts(spark, documents, vocabularies, monkeypatch, share):
    monkeypatch.setattr(alignment, "COMMON_SHARE", share)  # all, some or no pairs are sent to tasks
    texts = odd_texts()
    docs = documents([(k, t, "en", "s") for k, t in enumerate(texts)]).withColumns({"key": F.lit(1), "pairs": F.lit("x"), "count": F.lit(2)})
    rows = alignment.align_documents(docs.repartition(3), vocabularies).orderBy("doc_id").collect()
    wanted = plain(texts, vocabularies)
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == wanted


def test_groups_and_forgetting_change_nothing(vocabularies, monkeypatch):
    import pyarrow as pa

    texts = pa.array([t for t in odd_texts() if t])
    once = alignment.Aligner(vocabularies).align(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    small = alignment.Aligner(vocabularies)
    parts = pa.concat_tables([small.align(texts.slice(k, 7)) for k in range(0, len(texts), 7)])
    assert parts.to_pylist() == once.to_pylist()


def test_texts_that_may_not_be_split_give_the_same(vocabularies):
    import pyarrow as pa

    texts = pa.array([t for t in odd_texts() if t])
    whole = alignment.Aligner(vocabularies)
    whole.splits = False
    assert whole.align(texts).to_pylist() == alignment.Aligner(vocabularies).align(texts).to_pylist()


def test_empty_table_text_keys_and_repeated_rows(spark, documents, vocabularies):
    assert alignment.align_documents(documents([]), vocabularies).collect() == []
    rows = spark.createDataFrame([("k", "a b c"), ("k", "a b c"), (None, None)], "doc_id string, text string")
    found = alignment.align_documents(rows, vocabularies).orderBy(F.col("doc_id").desc()).collect()
    assert [(r["doc_id"], r["n_links"], r["count_sum"]) for r in found] == [("k", 3, 6), ("k", 3, 6), (None, 0, 0)]
    assert found[0]["groups_sha256"] == found[1]["groups_sha256"] != "" == found[2]["groups_sha256"]
