import tracemalloc
import zlib

import numpy as np
import pytest

from subledger.llm import quality_cnn as C

from .conftest import SF_MID


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in C.op9_byte_cnn(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    told = [r["quality"] == got[r["doc_id"]]["predicted"] for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean(told) >= 0.95


def test_gradients_match_differences():
    net = C.Network(1)
    net.bias[:] = np.random.default_rng(3).normal(0, 0.2, C.FILTERS)  # off the rectifier's edge, also without text
    run, y, w = [b"some text here", b"", b"another, longer one " * 5], np.array([1.0, 0.0, 0.0]), np.ones(3)

    def loss():
        p = net.probability(run)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    g = net.gradients(run, y, w)
    rng = np.random.default_rng(0)
    for part in ("now", "next", "lag", "out", "bias", "base"):
        x = getattr(net, part)
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in x.shape)
            old = x[at]
            x[at] = old + 3e-3
            up = loss()
            x[at] = old - 3e-3
            down = loss()
            x[at] = old
            assert abs((up - down) / 6e-3 - g[part][at]) < 2e-3, part


def test_whole_text_counts():
    """A mark at the very end of a long text changes the response; neighbours in a batch do not."""
    net = C.Network(2)
    long = b"plain words and more of them " * 4000
    a, b = net.probability([long])[0], net.probability([long + b"####$$$$%%%%&&&&####$$$$"])[0]
    assert a != b
    together = net.probability([long, b"x", b"", long + b"####$$$$%%%%&&&&####$$$$"])
    assert np.allclose([together[0], together[3]], [a, b])


def plain_probability(net, text):
    """The network's definition, one window and one filter at a time."""
    b = [0] * 40 + list(text) + [0] * 40
    peaks = np.full(C.FILTERS, -np.inf)
    for row in range(max(1, -(-len(text) // C.STRIDE))):
        at = 40 + row * C.STRIDE
        x = [net.embed[v] for v in b[at : at + C.WINDOW]]
        half = C.STRIDE
        match = [sum(b[k] != 0 and b[k] == b[k - lag] and k - lag >= 40 for k in range(max(40, at - 16), at + 8)) / 24
                 for lag in C.LAGS]
        peaks = np.maximum(peaks, np.concatenate(x[:half]) @ net.now + np.concatenate(x[half:]) @ net.next
                           + np.array(match) @ net.lag + net.bias)
    z = np.maximum(peaks, 0) @ net.out + net.base[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@pytest.mark.parametrize("piece", [400_000, 64, 8])
def test_probability_matches_plain_loop_wherever_stretches_end(monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE", piece)
    rng = np.random.default_rng(4)
    run = [b"", b"a", b"eight by", b"seventeen letters", b"ab" * 60, "züge über Brücken. ".encode() * 9,
           bytes(rng.integers(0, 256, 333, dtype=np.uint8)), b"aaaaaaaaaaaa" + bytes(20) + b"aaaa"]
    net = C.Network(6)
    got = net.probability(run)
    assert np.allclose(got, [plain_probability(net, t) for t in run], atol=1e-5)
    y, w = np.arange(len(run)) % 2.0, np.ones(len(run))
    now = net.gradients(run, y, w)
    monkeypatch.setattr(C, "PIECE", 400_000)
    for part, g in net.gradients(run, y, w).items():
        assert np.allclose(now[part], g, atol=1e-5), part


def test_memory_does_not_grow_with_a_text():
    """Beside the text itself, a long text takes no more than its stretches."""
    net, peak = C.Network(2), []
    for size in (4_000_000, 16_000_000):
        text = b"plain words " * (size // 12)
        tracemalloc.start()
        net.probability([text])
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peak[1] < 1.2 * peak[0] and peak[1] < 120e6


def test_odd_and_empty(odd_docs, odd_labels, no_docs, labels):
    got = C.op9_byte_cnn(odd_docs, odd_labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert C.op9_byte_cnn(no_docs, labels).count() == 0
    assert {r["score"] for r in C.op9_byte_cnn(odd_docs, odd_labels.limit(0)).collect()} == {0.5}
