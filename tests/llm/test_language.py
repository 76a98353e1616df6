import random

import numpy as np

from jobloom.llm import language

SYLLABLES = {
    "aa": ["the", "ing", "and", "tion", "er"], "bb": ["sch", "ung", "keit", "ein", "ß"], "cc": ["eau", "ais", "qué", "é", "oi"],
}


def text(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def corpus(n, seed=1):
    r = random.Random(seed)
    langs = [r.choice(list(SYLLABLES)) for _ in range(n)]
    return [(k, text(r, lang, r.randint(5, 60)), lang, "s") for k, lang in enumerate(langs)]


def test_gradients_equal_differences():
    g = np.random.default_rng(0)
    network = language.Network.fresh(["a", "b"], 2)
    for name in ("embed", "recur", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    data, answer = g.integers(97, 103, (6, 5)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        p, _ = network.label(data)
        return -np.log(p[:, np.arange(6), answer]).mean()

    for weights, grad in zip(network.weights, network.learn(data, answer), strict=True):
        for _ in range(6):
            at = tuple(g.integers(0, s) for s in weights.shape)
            if weights is network.embed:
                at = (at[0], int(g.integers(97, 103)), at[2])
            old = weights[at]
            weights[at] = old + 1e-4
            up = loss()
            weights[at] = old - 1e-4
            down = loss()
            weights[at] = old
            assert abs((up - down) / 2e-4 - grad[at]) < 2e-3 * max(1, abs(grad[at]))


def test_held_out_accuracy(documents):
    rows = corpus(400)
    found = {r["doc_id"]: r for r in language.identify_documents(documents(rows)).collect()}
    held = [k for k, *_ in rows if found[k]["held_out"]]
    right = sum(found[k]["lang_pred"] == rows[k][2] for k in held)
    assert len(held) > 50
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_prediction_ignores_language_source_and_id(documents):
    rows = corpus(200)
    network = language.train([r[1] for r in rows], [r[2] for r in rows], steps=150)
    texts = [r[1] for r in rows]
    once, labeller = language.Labeller(network)(texts), language.Labeller(network)
    single = [labeller([t]) for t in texts]
    assert once["lang_pred"] == [s["lang_pred"][0] for s in single]
    assert np.allclose(once["score"], [s["score"][0] for s in single], atol=1e-5)


def test_defined_cases(documents):
    rows = corpus(120) + [(500, None, "aa", "s"), (501, "", "aa", "s"), (502, "12 !?", "aa", "s"), (503, "thing " * 20000, None, None), (None, "keitung", "bb", "s")]
    found = {r["doc_id"]: r for r in language.identify_documents(documents(rows)).collect()}
    assert [found[k]["lang_pred"] for k in (500, 501, 502)] == ["und"] * 3
    assert found[503]["lang_pred"] == "aa"
    assert found[None]["held_out"] is False
    none = language.identify_documents(documents([(1, "abc", None, "s")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert language.identify_documents(documents([])).count() == 0


def test_more_languages_than_the_bound_are_all_learnt_from(documents, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    monkeypatch.setattr(language, "SAMPLE_ROWS", 10)
    frame = documents([(k, f"text{k}", f"l{k % 5}", "s") for k in range(100)])
    found = language.sample(frame, "doc_id", "text", "lang")
    assert sorted(x for _, x in found) == [f"l{k}" for k in range(5) for _ in range(4)]
