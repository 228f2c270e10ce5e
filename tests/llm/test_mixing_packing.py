"""Mixing and packing, and the whole pipeline."""

from __future__ import annotations

import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from corpus_rows import SF_SMALL, documents, texts
from duepulse.llm import mixing, packing, queries, tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_sainte_lague(votes, seats, most):
    held = [0] * len(votes)
    for _ in range(seats):
        open_to = [i for i in range(len(votes)) if votes[i] > 0 and held[i] < most[i]]
        if not open_to:
            break
        held[max(open_to, key=lambda i: (Fraction(int(votes[i]), 2 * held[i] + 1), -i))] += 1
    return held


def test_sainte_lague_gives_the_highest_quotients():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 7)
        votes = [rng.choice((0, 1, 3, 10, 10, 57, 1000)) for _ in range(n)]
        most = [rng.choice((0, 1, 5, 100)) for _ in range(n)]
        seats = rng.randint(0, 60)
        got = mixing.sainte_lague(np.array(votes), seats, np.array(most))
        assert got.tolist() == plain_sainte_lague(votes, seats, most), (votes, seats, most)


def test_targets_reshare_what_a_source_lacks():
    mix = mixing.Mix()
    sizes = np.array([10, 1000, 1000, 0, 500])
    got = mixing.targets(sizes, mix)
    assert got[0] == 20 and got[3] == 0 and (got <= 2 * sizes).all()
    assert got.sum() == pytest.approx(1.5 * sizes.sum())
    free = [i for i in range(5) if got[i] < 2 * sizes[i]]
    weights = np.resize([5, 2, 1], 5)
    assert len({round(got[i] / weights[i], 6) for i in free}) == 1
    assert mixing.targets(np.array([0, 0]), mix).tolist() == [0, 0]


def corpus(rng, n=300):
    rows = [(i, " ".join("w%d" % rng.randrange(99) for _ in range(rng.choice((0, 1, 30, 200)))), "en", rng.choice(("a", "b", "b", "ü", "z", None))) for i in range(n)]
    return rows + [(900, None, "en", "a"), (901, "", None, "nothing"), (902, "v " * 60_000, "en", "b"), (None, "x y\tz\n", "en", "c"), (5, "twice here", "en", "a")]


@pytest.mark.parametrize(("block", "shard"), [(64, 1 << 20), (5, 500), (1, 100)])
def test_mix(spark, block, shard):
    rows = corpus(random.Random(block))
    mix = mixing.Mix(block_words=block, shard_words=shard)
    got = mixing.mix_sources(documents(spark, rows), mix).collect()
    size = sorted((-1 if i is None else i, len(WORD.findall(t or ""))) for i, t, _, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"]) for r in got) == size
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    assert sum(r["size"] for r in got) * 1.5 == pytest.approx(sum(rs[0].target for rs in by.values()))
    for rs in by.values():
        assert rs[0].source_size == sum(r["size"] for r in rs)
        assert sum(r.taken for r in rs) == pytest.approx(rs[0].target, abs=max(3 * block, 0.02 * rs[0].target))
    again = mixing.mix_sources(documents(spark, rows).repartition(9), mix).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_have_the_words_taken(spark):
    rows = corpus(random.Random(4))
    mix = mixing.Mix(block_words=7, shard_words=600)
    docs = documents(spark, rows)
    made = mixing.mixed_documents(docs, mix)
    assert made.columns == docs.columns
    words, texts_of = {}, {}
    for r in made.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
        texts_of.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == len(r.text) and r["size"] == 7
    taken = {}
    for r in mixing.mix_sources(docs, mix).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert words == {i: n for i, n in taken.items() if n}
    whole = {i: t for i, t, _, _ in rows if i != 5}
    assert all(t in whole[i] or set(WORD.findall(t)) <= set(WORD.findall(whole[i])) for i, ts in texts_of.items() if i != 5 for t in ts)


def test_mix_of_odd_tables(spark):
    assert mixing.mix_sources(texts(spark, (1, "")).limit(0)).collect() == []
    (r,) = mixing.mix_sources(texts(spark, (1, " "))).collect()
    assert (r["size"], r.taken, r.target) == (0, 0, 0)


def test_pieces_against_the_tokenizer(spark):
    rng = random.Random(6)
    odd = ["", None, "a", "İstanbul ǅ ﬁ x́", "tab\tnew\nline\x0b\x1c\x85\xa0  z", "<|endoftext|> it's 'S 12 3,4", "é" * 3000,
           "Wörter. " * 1500, "😀 ok", " ".join(str(rng.random()) for _ in range(900)), "don't DON'T we'll"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(50, "twice"), (50, "twice"), (None, "no id")]
    got = packing.pack(texts(spark, *rows), tokenizer_path=PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i, k, 2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(np.split(ids, range(2048, len(ids), 2048)))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(texts(spark, (1, "")).limit(0), tokenizer_path=PATH).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    rng = np.random.default_rng(7)
    lengths = rng.integers(1, 2048, 3000)
    for capacity in (packing.Capacity(), packing.Capacity(2048, 3, 2048 * 2048), packing.Capacity(2048, 2048, 2_500_000 + 2047 * 2047)):
        bins, offsets = packing.best_fit(lengths, capacity, rule)
        for b in np.unique(bins):
            mine = lengths[bins == b]
            assert mine.sum() <= capacity.tokens and len(mine) <= capacity.documents
            assert (mine.astype(np.int64) ** 2).sum() <= capacity.attention
            assert sorted(offsets[bins == b]) == sorted(np.concatenate(([0], np.cumsum(mine[np.argsort(offsets[bins == b])])[:-1])))
    bins, _ = packing.best_fit(lengths, packing.Capacity(), "norm")
    assert bins.max() + 1 <= 1.02 * -(-lengths.sum() // 2048) + 1
    with pytest.raises(ValueError):
        packing.best_fit(np.array([3000]), packing.Capacity())
    with pytest.raises(ValueError):
        packing.best_fit(np.array([30, 30]), packing.Capacity(), "first")


def test_pipeline_stage_by_stage(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    docs = tables.read(spark, SF_SMALL, "documents")
    columns = docs.columns
    labels = {r.doc_id: r.toxic for r in tables.read(spark, SF_SMALL, "labels").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = tables.stored(corpus_pipeline.drop_toxic(spark, docs, SF_SMALL))
    clean = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == columns and clean.items() <= before.items()
    right = [(i in clean) != bool(toxic) for i, toxic in labels.items()]
    assert sum(right) >= 0.95 * len(right)

    lines = tables.stored(corpus_pipeline.drop_repeated_lines(spark, kept, SF_SMALL))
    assert lines.columns == columns
    from test_native import dedup_plain

    left = dedup_plain(sorted(clean.items()))
    got = {r.doc_id: r.text for r in lines.collect()}
    assert got == {i: t for i, t in left.items() if t == clean[i] or WORD.search(t)}

    one = tables.stored(corpus_pipeline.drop_near_copies(spark, lines, SF_SMALL))
    from test_joins import components_of, shingle_set

    sets = {i: shingle_set(t, 5) for i, t in got.items()}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * (o := len(sets[a] & sets[b])) >= 80 * (len(sets[a] | sets[b]))]
    component = components_of(sets, linked)
    assert {r.doc_id for r in one.collect()} == {i for i, c in component.items() if i == c}

    mixed = tables.stored(corpus_pipeline.mix(spark, one, SF_SMALL))
    assert mixed.columns == columns
    before = sum(len(WORD.findall(r.text)) for r in one.collect())
    after = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert after == pytest.approx(1.5 * before, rel=0.02)
    packed = corpus_pipeline.pack(spark, mixed, SF_SMALL).collect()
    assert len({(r.doc_id, r.piece) for r in packed}) <= len(packed) and packed
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(packed)


def test_stages_pass_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "x " * 30_000, "en", "a"), (4, "plain words here", "en", "b"), (4, "plain words here", "en", "b"), (None, "no id here", None, "b")]
    for docs in (documents(spark, rows), documents(spark, rows).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = tables.stored(stage(spark, docs, SF_SMALL))
        assert "sequence_id" in docs.columns and "size" in columns


@pytest.mark.parametrize("name", queries.queries())
def test_each_query_runs(spark, name):
    found = queries.queries()[name](spark, SF_SMALL)
    table = {"op6": "embeddings", "op11": "embeddings", "op13": "pages"}.get(name.split("_")[0], "documents")
    rows = found.count()
    assert rows >= tables.read(spark, SF_SMALL, table).count()
