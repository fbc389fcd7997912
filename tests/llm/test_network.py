"""The byte convolutional network: its gradients, and the tables that apply it."""

import numpy as np

from strata.llm import language_id
from strata.llm.language_id import CLASSES, FILTERS, WIDTHS, WINDOW, Network
from strata.llm.ship import ship


def network(seed):
    rng = np.random.default_rng(seed)
    net = Network.random(["a", "b", "c"], rng)
    net.shifts = [rng.normal(0, 0.3, FILTERS).astype(np.float32) for _ in WIDTHS]
    return net, rng.integers(0, CLASSES, (70, WINDOW)).astype(np.uint8), rng.integers(0, 3, 70)


def direct(net, x):
    """Probabilities by the plain definition: every filter at every place."""
    out = []
    for row in x:
        e = net.embedding[row].astype(np.float64)
        pooled = []
        for kernel, shift in zip(net.kernels, net.shifts, strict=True):
            w = len(kernel)
            response = [sum(e[at + j] @ kernel[j] for j in range(w)) for at in range(len(row) - w + 1)]
            pooled += list(np.max(response, 0) + shift)
        logits = np.maximum(pooled, 0) @ net.dense + net.bias
        p = np.exp(logits - logits.max())
        out.append(p / p.sum())
    return np.array(out)


def test_tables_equal_the_convolution():
    net, x, _ = network(1)
    np.testing.assert_allclose(net.compiled().probabilities(x), direct(net, x), atol=1e-5)


def test_gradients_equal_finite_differences():
    net, x, y = network(2)
    x, y = x[:12, :40], y[:12]
    for name in ("embedding", "dense", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.kernels = [k.astype(np.float64) for k in net.kernels]
    net.shifts = [s.astype(np.float64) for s in net.shifts]
    loss = lambda: -np.log(direct(net, x)[np.arange(len(y)), y]).mean()
    rng = np.random.default_rng(3)
    for p, g in zip(net.parameters(), net.gradients(x, y), strict=True):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(4)]:
            kept, step = p[at], 1e-6
            p[at] = kept + step
            up = loss()
            p[at] = kept - step
            down = loss()
            p[at] = kept
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4


def test_an_untrained_table_judges_nothing(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, None, "words")], "doc_id long, lang string, text string")
    assert language_id.train(language_id.sample(docs)) is None
    assert [tuple(r) for r in language_id.identify(docs).collect()] == [(1, False, "und", 0.0)]
