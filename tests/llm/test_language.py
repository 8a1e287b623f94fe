import random

import numpy as np

from cases import SF_ORACLE, empty, odd  # noqa: F401
from visitlens.llm import language as L
from visitlens.llm.queries import language_network, op3_language


def test_gradients():
    rng = np.random.default_rng(3)
    net = L.Network(["a", "b", "c"], hidden=3)
    for layer in (net.ahead, net.behind):
        layer.inputs, layer.state = layer.inputs.astype(float), layer.state.astype(float)
    x, y = rng.integers(0, 5, (7, 6)), rng.integers(0, 3, 6)
    _, grads = net.gradients(x, y)
    for w, g in zip(net._weights(), grads):
        for _ in range(6):
            at = tuple(int(rng.integers(0, s)) for s in w.shape)
            if w.ndim == 2 and w.shape[0] == 256:
                at = (int(rng.integers(0, 5)), at[1])
            keep, step = w[at], 1e-2
            w[at] = keep + step
            up, _ = net.gradients(x, y)
            w[at] = keep - step
            down, _ = net.gradients(x, y)
            w[at] = keep
            assert abs((up - down) / (2 * step) - g[at]) < 2e-3


def test_windows_cover_each_byte_once():
    net = L.Network(["a", "b"])
    rng = random.Random(1)
    texts = [bytes(rng.randrange(97, 123) for _ in range(n)) for n in (0, 1, 63, 64, 65, 200, 128)]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    p = net.documents(np.frombuffer(b"".join(texts), np.uint8), off)
    assert np.allclose(p.sum(axis=1), [0, 1, 1, 1, 1, 1, 1], atol=1e-5)
    for k, t in enumerate(texts):
        if t:
            alone = net.documents(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
            assert np.allclose(alone[0], p[k], atol=1e-5)


def test_held_out_accuracy(spark):
    got = op3_language(spark, SF_ORACLE).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    out = [r for r in got if r.held_out]
    assert len(got) == len(truth) and 100 < len(out) < len(truth) / 2
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark, odd, empty):
    net = language_network(odd)
    rows = L.identify(odd, net).collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["row"].text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert (r.score > 0) == letters
        assert r.lang_pred in ("en", "de", "und")
    assert language_network(empty) is None
    assert L.identify(empty, None).count() == 0
    assert {r.lang_pred for r in L.identify(odd, None).collect()} == {"und"}


def test_every_label_is_learned(spark):
    """One id on a third of the rows, and a label of one row in 2,000."""
    rng = random.Random(3)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(20))
    rows = [(7, make("abc"), "aa") for _ in range(700)] + [(i, make("xyz"), "bb") for i in range(1300)]
    rows += [(5000, make("qrs"), "zz"), (5001, "...", "none"), (None, make("abc"), "bb")]
    df = spark.createDataFrame(rows, "key long, text string, label string")
    net = L.fit(df, rows=200)
    assert net.labels == ["aa", "bb", "zz"]
    told = L.identify(df, net, key="key").select("key", "lang_pred").collect()
    assert sum(r.lang_pred == "zz" for r in told if r.key == 5000) == 1
    assert sum(r.lang_pred == "aa" for r in told if r.key == 7) >= 690
    assert L.fit(df.where("1 = 0")) is None
