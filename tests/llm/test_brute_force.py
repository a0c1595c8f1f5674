"""op4, op7 and op10 on the smallest tables against plain loops over all their rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tendril.llm import language_id as L
from tendril.llm import quality_model as M
from tendril.llm import sharding as S

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def trigram_shares(text):
    data = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in b" " + text.lower().encode() + b" ")
    counts = Counter()
    for k in range(len(data) - 2):
        a, b, c = data[k : k + 3]
        if not a == b == 32:
            counts[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20] += 1
    return {k: math.sqrt(n / sum(counts.values())) for k, n in counts.items()}


def test_languages_bit_by_bit(spark, docs, monkeypatch):
    """Every bit's margin, every codeword's loss and the choice among them; the training rows are all of the folds'."""
    taught, plain = [], L.train
    monkeypatch.setattr(L, "train", lambda x, langs: taught.extend(langs) or plain(x, langs))
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    model = L.fit(frame.where(~L.held_out()))
    known = {(d.doc_id, d.lang) for d in docs.values() if fold(d.doc_id, 5) and d.text is not None and d.lang is not None and any(map(str.isalpha, d.text))}
    assert Counter(taught) == Counter(lang for _, lang in known) and model.langs == sorted({lang for _, lang in known})
    rows = {r.doc_id: r for r in L.op7_language_codes(spark, DATA).collect()}
    assert rows.keys() == docs.keys()
    for i, d in docs.items():
        x = trigram_shares(d.text)
        margins = [sum(v * float(model.weights[k, bit]) for k, v in x.items()) + float(model.bias[bit]) for bit in range(model.code.shape[1])]
        losses = [sum(t * math.log1p(math.exp(-m * c)) for m, c, t in zip(margins, word, model.trust, strict=True)) for word in model.code]
        chances = [math.exp(min(losses) - loss) for loss in losses]
        top = sorted((p / sum(chances) for p in chances), reverse=True)
        assert rows[i].held_out == (fold(i, 5) == 0) and abs(rows[i].score - top[0]) < 1e-4
        assert rows[i].lang_pred == model.langs[losses.index(min(losses))] or top[0] - top[1] < 1e-4
        assert rows[i].ambiguous == (top[0] - top[1] < L.AMBIGUOUS) or abs(top[0] - top[1] - L.AMBIGUOUS) < 1e-4


def test_quality_word_by_word(spark, docs):
    """Vocabulary, word vectors, pooling and the network's two layers."""
    frame, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    apart = M.crc_of_id() % 4 == 2
    model = M.fit(frame.where(~apart), labels.where(~apart))
    marks = defaultdict(set)
    for r in labels.collect():
        marks[r.doc_id].add(r.quality)
    taught = [docs[i].text or "" for i, m in marks.items() if i in docs and fold(i, 4) != 2 and len(m) == 1 and m <= {0, 1}]
    counts = Counter(t for text in taught for w in M.TOKEN.findall(text) for t in (w, M.shape(w)))
    names = sorted(counts, key=lambda w: (-counts[w], w))[: M.VOCABULARY]
    assert model.words.names == names
    known = set(names)
    read = lambda text: [w if w in known else M.shape(w) if M.shape(w) in known else None for w in M.TOKEN.findall(text)]
    index = {w: M.index_vector(w) for w in names}
    sums = {w: np.zeros(M.DIM) for w in names} | {None: np.zeros(M.DIM)}
    for text in taught:
        words = read(text)
        for k, w in enumerate(words):
            for near in (k - 2, k - 1, k + 1, k + 2):
                if 0 <= near < len(words) and words[near] is not None:
                    sums[w] += index[words[near]]
    vectors = {w: v / max(np.linalg.norm(v), 1e-6) for w, v in sums.items()}
    assert all(np.allclose(model.vectors[k], vectors[w], atol=1e-5) for k, w in enumerate(names))
    net, rows = model.network, {r.doc_id: r for r in M.op4_quality_model(spark, DATA).collect()}
    assert rows.keys() == docs.keys()
    for i, d in docs.items():
        seen = [vectors[w] for w in read(d.text or "")]
        mean = sum(seen) / len(seen)
        spread = np.sqrt(np.maximum(sum(v * v for v in seen) / len(seen) - mean**2, 0))
        pairs = sum((a * b for a, b in zip(seen, seen[1:], strict=False)), np.zeros(M.DIM)) / max(1, len(seen) - 1)
        x = [*mean, *spread, *pairs, *(np.linalg.norm(p) for p in (mean, spread, pairs))]
        hidden = [math.tanh(sum((v - m) / s * w for v, m, s, w in zip(x, net.mean, net.scale, net.w1[:, h], strict=True)) + net.b1[h]) for h in range(M.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, net.w2, strict=True)) + net.b2
        assert abs(rows[i].score - 1 / (1 + math.exp(-logit / net.temperature))) < 1e-3
        assert rows[i].held_out == (fold(i, 4) == 2) and rows[i].predicted == int(rows[i].score >= 0.7)


@pytest.mark.parametrize("shards", [24, 7])
def test_shards_cut_by_cut(spark, docs, shards):
    """Each node is sorted along its widest dimension and cut where its bytes come nearest to the share."""
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = S.metadata(frame).collect()
    want = {}

    def split(node, first, k):
        if k == 1 or not node:
            want.update({r.doc_id: first for r in node})
            return
        wide = {d: max(r[f"at_{d}"] for r in node) - min(r[f"at_{d}"] for r in node) for d in S.DIMENSIONS}
        along = max(S.DIMENSIONS, key=wide.get)
        node = sorted(node, key=lambda r: r[f"at_{along}"])
        share = sum(r.size for r in node) * (k // 2) / k
        cut = min(range(len(node) + 1), key=lambda n: abs(sum(r.size for r in node[:n]) - share))
        split(node[:cut], first, k // 2)
        split(node[cut:], first + k // 2, k - k // 2)

    split(rows, 0, shards)
    got = S.kd_shards(frame, shards).collect()
    assert {r.doc_id: r.shard for r in got} == want and len(got) == len(docs)
    for shard in set(want.values()):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own))) and [r.doc_id for r in own] == sorted(r.doc_id for r in own)
