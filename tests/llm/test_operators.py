"""Operators of the training-data package against brute force on small tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import sys
import time
import tracemalloc
import types
import weakref
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import ann, line_dedup, mixing, near_dedup, packing, quality, sketches, substring_dedup, token_files, token_ids, url_filter, warc
from millrace.storage import work_folder

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, size=400):
    return " ".join(f"w{x}" for x in rng.integers(0, size, n))


def sample_texts() -> list[str | None]:
    """Copies, near copies, shared passages and lines, very short, empty, NULL and long texts."""
    rng = np.random.default_rng(3)
    passage, line = sentence(rng, 60), "Read  MORE here"
    texts: list[str | None] = [None, "", "  \n ", "one", "a b c", "x " * 200]
    for i in range(12):
        base = sentence(rng, 120).split()
        near = [*base[:60], "changed", *base[61:]]
        texts += [" ".join(base), " ".join(base), " ".join(near), f"{sentence(rng, 30)}\n{line}\n{sentence(rng, 40)} {passage} {sentence(rng, 9)}\n {line.lower()}\t"]
    texts.append(sentence(rng, 6_000, 5_000))
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    """Also an extra column with a clashing name, a NULL source, a repeated row and a NULL id."""
    texts = sample_texts()
    rows = [(i, t, "en", None if i % 7 == 0 else ("hot" if i % 3 else f"s{i % 4}"), len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[6], (None, "an id is missing here", None, None, None)], SCHEMA)
    return df.withColumns({"kept": F.lit("x"), "tokens": F.lit(1), "words": F.lit(None).cast("string")}).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def local(docs):
    return [r.asDict() for r in docs.collect()]


# -- tokens ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet=" \n\t\u00a0abcABé.,'!1<|", max_size=40)), max_size=5))
def test_token_ids_are_the_library_s(path, texts):
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)] if texts else []
    got = token_ids.token_ids(path)(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_memory_of_pieces_is_bounded():
    small = token_ids.TokenIds(BYTE_BPE, keep=3)
    texts = ["one two three", "four five six seven, eight", "one"]
    assert [small([t])[0] for t in texts] == token_ids.TokenIds(BYTE_BPE)(texts)


def test_an_encoder_that_idles_goes(monkeypatch):
    kept = sys.modules.setdefault("_token_ids_of_this_worker", types.ModuleType("_token_ids_of_this_worker")).__dict__
    kept.pop(BYTE_BPE, None)
    monkeypatch.setattr(token_ids, "IDLE", 0.5)
    encoder = token_ids.token_ids(BYTE_BPE)
    assert token_ids.token_ids(BYTE_BPE) is encoder  # from one task to the next
    want, gone = encoder(["alpha beta"]), weakref.ref(encoder)
    assert encoder.idle() < 0.5 and kept[BYTE_BPE] is encoder
    encoder._calls += 1  # as in a call that takes long
    time.sleep(1)
    assert encoder.idle() == 0 and kept[BYTE_BPE] is encoder
    encoder._calls -= 1
    for _ in range(100):
        if BYTE_BPE not in kept:
            break
        time.sleep(0.1)
    assert BYTE_BPE not in kept
    assert encoder(["alpha beta"]) == want  # for a task that holds it
    del encoder
    assert gone() is None
    assert token_ids.token_ids(BYTE_BPE)(["alpha beta"]) == want


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_are_encoded_once_and_marks_apart_from_their_word(path, monkeypatch):
    encoder, asked = token_ids.TokenIds(path), []
    encoder(["alpha beta"])
    for name in ("_encode", "_encode_spaced"):
        monkeypatch.setattr(encoder, name, lambda pieces, ask=getattr(encoder, name): asked.extend(pieces) or ask(pieces))
    texts = ["", "beta&&& alpha beta&&& beta&&&", "alpha,###\nbeta gamma", "gamma"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_ids, "_LOT", 30)
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder(texts)] == want
    assert sorted(filter(None, asked)) == sorted(["beta", "&&&", ",###", "\nbeta", " gamma", "gamma"])


def test_new_words_of_a_tokenizer_with_word_ends_need_no_offsets(monkeypatch):
    encoder = token_ids.TokenIds(WORD_BPE)
    texts = ["Alpha \u00c9t\u00e9 alpha,\nbeta gamma", "delta " * 700 + "x"]
    want = [e.ids for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]

    class Fast:
        def __init__(self, inner):
            self.encode_batch_fast = inner.encode_batch_fast  # and no encode_batch

    monkeypatch.setattr(encoder, "_tokenizer", Fast(encoder._tokenizer))
    assert [np.frombuffer(g, "<u4").tolist() for g in encoder(texts)] == want
    monkeypatch.undo()
    again = token_ids.TokenIds(WORD_BPE)
    again._closes = np.zeros_like(again._closes)  # ends that do not come out even
    assert [np.frombuffer(g, "<u4").tolist() for g in again(texts)] == want


# -- packing -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 300, 500)
    capacity = packing.Capacity(tokens=512, max_documents=4, max_cost=120_000)
    bins, place, _ = packing.fit(lengths, capacity, rule)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 512 and len(own) <= 4 and (own**2).sum() <= 120_000
        order = np.argsort(place[bins == b])
        assert (np.cumsum(own[order]) - own[order]).tolist() == place[bins == b][order].tolist()


def test_fit_fills_sequences():
    lengths = np.random.default_rng(2).integers(1, 1500, 3000)
    bins, _, _ = packing.fit(lengths, packing.Capacity(2048))
    assert len(set(bins.tolist())) <= 1.01 * -(-lengths.sum() // 2048)


def test_pack_documents(docs):
    got = local(packing.pack_documents(docs, BYTE_BPE))
    tk, want = Tokenizer.from_file(BYTE_BPE), Counter()
    for d in local(docs):
        ids, at = [*tk.encode(d["text"] or "", add_special_tokens=False).ids, 0], 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 2048)):
            want[(d["doc_id"], k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()))] += 1
            at += n
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


# -- token files -------------------------------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.int64)
    table = token_files.PerfectHash.frombytes(token_files.PerfectHash.build(keys).tobytes())
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))


def test_token_files_round_trip(spark, docs):
    index = token_files.write_shards(docs.repartition(3), work_folder(spark, "tok"), WORD_BPE)
    tk, at, want = Tokenizer.from_file(WORD_BPE), 0, []
    for d in local(docs):
        want.append((d["doc_id"], [*tk.encode(d["text"] or "", add_special_tokens=False).ids, 1]))
    got = sorted(local(token_files.read_documents(index)), key=lambda r: r["start"])
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in want), key=lambda i: (i is not None, i))
    crc = Counter((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == crc
    keys = spark.createDataFrame([(3,), (6,), (10_000,), (None,)], "doc_id long")
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in local(token_files.lookup_documents(index, keys)))
    assert found == Counter((i, tuple(ids)) for i, ids in want if i in (3, 6))


# -- lines -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1 << 20, line_dedup.BLOOM_BITS])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_dedup_lines(docs, bits, keep):
    rows = local(docs)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    n = Counter(k for r in rows for k in {key(x) for x in (r["text"] or "").split("\n")} if k)
    first = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"])):
        for at, x in enumerate((r["text"] or "").split("\n")):
            first.setdefault(key(x), (r["doc_id"], at))
    want = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for at, x in enumerate(lines) if n[key(x)] < 10 or keep == "first" and first[key(x)] == (r["doc_id"], at)]
        want[(r["doc_id"], "\n".join(left), len(lines), len(lines) - len(left), r["kept"])] += 1
    got = local(line_dedup.dedup_lines(docs, 10, 1, keep, bits))
    assert Counter((r["doc_id"], r["text"] or "", r["__lines"], r["__dropped"], r["kept"]) for r in got) == want
    assert any(r["__dropped"] for r in got)


# -- near duplicates ---------------------------------------------------------------------------------


def brute_classes(rows, config=near_dedup.NearDup()):
    """Class of each (id, text) by comparing the sets of shingles of all texts."""
    texts = {(r["doc_id"], r["text"]) for r in rows}
    sets = {}
    for k in texts:
        words = WORD.findall(k[1] or "")
        if words:
            n = min(config.words, len(words))
            sets[k] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    parent = {k: k for k in texts}

    def top(k):
        return k if parent[k] == k else top(parent[k])

    order = lambda k: (k[0] is not None, k[0] or 0, k[1] or "")
    for a, b in itertools.combinations(sorted(sets, key=order), 2):
        if len(sets[a] & sets[b]) >= config.similarity * len(sets[a] | sets[b]) and top(a) != top(b):
            x, y = sorted((top(a), top(b)), key=order)
            parent[y] = x
    return {k: top(k)[0] for k in texts}


def test_near_duplicates(docs):
    rows = local(docs.filter("doc_id is not null"))
    want = brute_classes(rows)
    got = local(near_dedup.near_duplicates(docs.filter("doc_id is not null")))
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter((r["doc_id"], want[(r["doc_id"], r["text"])]) for r in rows)
    kept = Counter(r["doc_id"] for r in local(near_dedup.keep_one(docs.filter("doc_id is not null"))))
    assert kept == Counter({c for c in want.values()})


def test_blocks_link_what_hubs_miss(spark, monkeypatch):
    """A chain of texts, each like the next only: all in one class, over several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rng = np.random.default_rng(5)
    words, texts = sentence(rng, 200, 10_000).split(), []
    for k in range(12):
        words[10 * k : 10 * k + 6] = [f"n{k}x{j}" for j in range(6)]
        texts.append((k, " ".join(words)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = [{"doc_id": i, "text": t} for i, t in texts]
    assert {r["doc_id"]: r["class_id"] for r in local(near_dedup.near_duplicates(frame))} == {k[0]: c for k, c in brute_classes(rows).items()}


def test_near_copies_of_a_text_with_a_missing_id(spark):
    """Same words, other white space, one row without an id: the node is compared by a text it has."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(8):
        base = sentence(rng, 120, 10_000).split()
        rows += [(10 * k + 1, " ".join(base)), (None, "  ".join(base)), (10 * k + 2, " ".join([*base[:60], "changed", *base[61:]]))]
    got = local(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert Counter((r["doc_id"], r["class_id"], r["first"]) for r in got) == Counter(
        row for k in range(8) for row in [(10 * k + 1, 10 * k + 1, True), (None, 10 * k + 1, False), (10 * k + 2, 10 * k + 1, False)]
    )


def plain_jaccard(a, b):
    x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_large_group_of_near_copies_is_one_class(spark):
    """Copies with changes of their own, each alike to the others at 0.8 to 0.9, among other texts."""
    rng = np.random.default_rng(9)
    base = sentence(rng, 130, 100_000).split()
    copies = [" ".join([*base[:lo], *(f"c{k}x{j}" for j in range(2)), *base[lo + 2 :]]) for k, lo in enumerate(rng.integers(4, 122, 3_000))]
    rows = [(k, t) for k, t in enumerate(copies)] + [(10_000 + k, sentence(rng, 60, 100_000)) for k in range(6_000)]
    assert min(plain_jaccard(copies[0], t) for t in copies[1:]) >= 0.8
    got = {r["doc_id"]: r["class_id"] for r in local(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert {got[k] for k in range(3_000)} == {0} and all(got[k] == k for k in got if k >= 10_000)


def test_class_of_a_pair_does_not_depend_on_the_corpus(spark):
    """Frequent shingles in common and rare ones changed: the pair is decided by the two texts."""
    rng = np.random.default_rng(10)
    shared, pair = sentence(rng, 104, 100_000), []
    for k in range(2):
        pair.append((k, f"{shared} {' '.join(f'u{k}x{j}' for j in range(7))}"))
    assert plain_jaccard(pair[0][1], pair[1][1]) >= 0.8
    for others in (0, 400):
        frame = spark.createDataFrame([*pair, *((10 + k, f"{shared} {sentence(rng, 300, 100_000)}") for k in range(others))], "doc_id long, text string")
        got = {r["doc_id"]: (r["class_id"], r["similar"]) for r in local(near_dedup.near_duplicates(frame))}
        assert got.pop(0) == got.pop(1) == (0, True) and all(v == (k, False) for k, v in got.items())


def shingle_counts(texts):
    """How often each text has each of its shingles, and how many different texts have a shingle."""
    tf = {w: Counter(w[i : i + 5] for i in range(len(w) - 4)) for w in {tuple(t.split()) for t in texts}}
    return tf, Counter(g for c in tf.values() for g in c)


def test_shingles_weigh_by_tf_idf(spark):
    """Rare words in common, frequent passages that differ: alike by weight only, however many copies there are."""
    rng = np.random.default_rng(12)
    passages, pairs = [sentence(rng, 30, 100_000) for _ in range(4)], []
    for k in range(20):
        rare = sentence(rng, 190, 100_000)
        pairs += [(2 * k, f"{rare} {passages[0]} {passages[1]}"), (2 * k + 1, f"{rare} {passages[2]} {passages[3]}")]
    others = [(100 + k, f"{sentence(rng, 150, 100_000)} {passages[k % 2 * 2]} {passages[k % 2 * 2 + 1]}") for k in range(600)]
    copies = [(1_000 + k, f" {pairs[0][1]}  ") for k in range(300)]
    rows = [*pairs, *others, *copies]
    tf, df = shingle_counts(t for _, t in rows)
    weight = {w: {g: n * (1 + np.log((len(tf) + 1) / (df[g] + 1))) for g, n in c.items()} for w, c in tf.items()}
    for (_, a), (_, b) in zip(pairs[::2], pairs[1::2], strict=True):
        x, y = weight[tuple(a.split())], weight[tuple(b.split())]
        alike = sum(min(x.get(g, 0), y.get(g, 0)) for g in x) / sum(max(x.get(g, 0), y.get(g, 0)) for g in {**x, **y})
        assert plain_jaccard(a, b) < 0.7 and alike >= 0.8
    got = {r["doc_id"]: r["class_id"] for r in local(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))}
    assert all(got[k] == k // 2 * 2 for k in range(40)) and all(got[k] == k for k, _ in others) and all(got[k] == 0 for k, _ in copies)


def test_a_pair_in_several_bands_is_compared_in_one(spark, monkeypatch):
    rng = np.random.default_rng(14)
    base, texts, agreeing = sentence(rng, 300, 100_000).split(), [], []
    for k in range(8):
        own = list(base)
        for at in (5 + 15 * k, 150 + 15 * k):
            own[at : at + 5] = [f"c{k}x{at}x{j}" for j in range(5)]
        texts.append((k, " ".join(own)))
    assert all(0.75 < plain_jaccard(a, b) < 0.8 for (_, a), (_, b) in itertools.combinations(texts, 2))
    other = sentence(rng, 200, 100_000)
    texts += [(8, other), (9, f"{other} more")]  # blocks are compared once there are links
    write = near_dedup.shared_table

    def noted(df, name):
        out = write(df, name)
        agreeing.extend([out] if name == "agreeing" else [])
        return out

    monkeypatch.setattr(near_dedup, "shared_table", noted)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    want = {k[0]: c for k, c in brute_classes([{"doc_id": i, "text": t} for i, t in texts]).items()}
    assert {r["doc_id"]: r["class_id"] for r in local(near_dedup.near_duplicates(frame))} == want and want[9] == 8
    assert 0 < agreeing[0].count() <= 8 * 7  # two rows a pair at most


def test_tables_of_texts_and_shuffles_do_not_stay(spark, docs, monkeypatch):
    """What only the search reads goes when it is over; a result reads digests and classes."""
    names, write = {}, near_dedup.shared_table

    def noted(df, name):
        out = write(df, name)
        names[name] = [f.removeprefix("file:").rpartition("/")[0] for f in out.inputFiles()][0]
        return out

    monkeypatch.setattr(near_dedup, "shared_table", noted)
    found = near_dedup.near_duplicates(docs)
    left = {n for n, folder in names.items() if Path(folder).exists()}
    assert {"frequent", "texts", "samples", "wanted-texts"} <= names.keys() and not left & {"frequent", "texts", "samples", "wanted-texts"}
    assert found.count() == docs.count()


def test_hashes_of_words_by_lots(monkeypatch):
    monkeypatch.setattr(sketches, "LOT", 20)
    texts = [b"", b" ", b"a", b" a b\n c\t", "\u00e9 x y\x85z \x1c q".encode(), b"w " * 50, None, b"x\x0b\x0cy\rz", b"\xff\xfe a \xc3"]
    for some in (pa.array(texts), pa.array(texts).slice(3), pa.array(texts).slice(3, 0), pa.array(["p q", None, "r"])):
        raw = some.cast(pa.binary()).to_pylist()
        assert [g.tolist() for g in sketches.hashed_words(some)] == [sketches.WordHashes().of((t or b"").split()).tolist() for t in raw]


def test_quality_stage_stores_a_text_once(spark, docs, monkeypatch):
    tables, write = [], quality.shared_table
    monkeypatch.setattr(quality, "shared_table", lambda df, name: tables.append(df) or write(df, name))
    got = corpus_pipeline.quality_rules(spark, docs, "")
    assert [str(f.dataType).count("'text'") + (f.name == "text") for f in tables[0].schema.fields].count(1) == 1 and got.columns == docs.columns
    want = quality.judge(docs.drop("kept")).filter("kept").withColumn("kept", F.lit("x")).select(*docs.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert corpus_pipeline.quality_rules(spark, docs.select("text", "source", "doc_id"), "").columns == ["text", "source", "doc_id"]


@pytest.mark.parametrize("parts", [1, 8])
def test_counts_of_shingles_are_exact(spark, parts):
    rng = np.random.default_rng(13)
    texts = list({sentence(rng, int(n), 3) for n in rng.integers(1, 60, 80)})
    frame = spark.createDataFrame([(k // 9, t) for k, t in enumerate(texts)], "chunk long, text string").repartition(5)
    grams = [sketches.shingles(sketches.WordHashes().of(t.encode().split()), 5)[0].tolist() for t in texts]
    df = Counter(g for own in grams for g in own)
    want = {(k // 9, g): df[g] for k, own in enumerate(grams) for g in own if df[g] > 1}
    got = {}
    for r in sketches.document_frequencies(frame, 5, parts).collect():
        got |= {(r["chunk"], h): c for h, c in zip(np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["counts"], np.uint32).tolist(), strict=True)}
    assert got == want and len({g for _, g in got}) < len(df)


def test_samples_agree_like_weighted_jaccard():
    rng, draw = np.random.default_rng(1), near_dedup.Sampler(2_000)
    h = np.sort(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    a, b = (h[:240], rng.uniform(1, 9, 240)), (h[60:], rng.uniform(1, 9, 240))
    b[1][:100] = a[1][60:160]
    assert abs(np.mean(draw(*a) == draw(*b)) - near_dedup.similarity(a, b)) < 0.05


def test_both_samples_are_the_defined_ones(monkeypatch):
    """Against the definitions, draw by draw; weights of one shingle, of many, and both."""
    monkeypatch.setattr(near_dedup, "_OFTEN", 40)
    monkeypatch.setattr(near_dedup, "_TABLES", 2)
    rng, draw = np.random.default_rng(7), near_dedup.Sampler(9)
    for n in (1, 5, 30, 300, 300, 300):
        h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for w in (np.ones(len(h)), rng.integers(1, 4, len(h)) * 1.5, rng.uniform(0.1, 9, len(h)), np.where(rng.random(len(h)) < 0.8, 2.5, rng.uniform(1, 9, len(h)))):
            order = np.argsort(w, kind="stable")
            plain, weighted = draw.both(h, w)
            for f, odd in enumerate(draw._odd.tolist()):
                product = [x * odd % (1 << 64) for x in h[order].tolist()]
                assert plain[f] == min(product) % (1 << 32)
                at = np.array([x >> 48 for x in product])
                score, t = draw._drawn(at, np.log(w[order]))
                k = int(np.argmin(score.astype(np.float32)))
                mark = int(h[order][k]) ^ (int(t[k]) * 0x9E3779B97F4A7C15 % (1 << 64))
                assert weighted[f] == mark >> 32


@pytest.mark.parametrize("module", [sketches, near_dedup, line_dedup])
def test_tasks_return_the_memory_they_freed(spark, module, monkeypatch):
    """A Python worker stays for a minute after its task, beside the next stages."""

    class Rows:
        schema, runs = defaultdict(lambda: types.SimpleNamespace(dataType=types.SimpleNamespace(simpleString=lambda: "long"))), []

        def mapInArrow(self, run, schema):
            self.runs.append(run)
            return self

        def toLocalIterator(self):
            return []

        def __getattr__(self, name):
            return lambda *a, **b: self

    rows, returned = Rows(), []
    monkeypatch.setattr(module, "give_back", lambda: returned.append(1), raising=False)
    if module is sketches:
        sketches.document_frequencies(rows, 5, 2)
        batch = pa.record_batch({"chunk": pa.array([1, 1], pa.int64()), "text": pa.array([b"a b c d e f", b"a b c d e"])})
    elif module is near_dedup:
        near_dedup._verified(rows, rows, 2, near_dedup.NearDup())
        batch = pa.record_batch({"a": [1], "b": [2], "x": [b"a b c d e f"], "y": [b"a b c d e f g"], "m": [b""], "n": [b""]})
    else:
        monkeypatch.setattr(line_dedup, "shuffle_partitions", lambda spark: 2)
        line_dedup.seen_again(rows, 1, line_dedup.SLICE_BITS)
        batch = pa.record_batch({"text": ["a\nb", "b"]})
    assert list(rows.runs[0](iter([batch]))) and returned


# -- repeats of passages -----------------------------------------------------------------------------


@pytest.mark.parametrize("length,gram", [(20, 10), (20, 6), (8, 3)])
def test_remove_repeats(docs, length, gram):
    rows = local(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]))
    seen, want = set(), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        words, gone = WORD.findall(r["text"] or ""), set()
        for p in range(len(words) - length + 1):
            window = tuple(words[p : p + length])
            if window in seen:
                gone.update(range(p, p + length))
            seen.add(window)
        want[r["doc_id"]] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    got = local(substring_dedup.remove_repeats(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), substring_dedup.Repeats(length, gram)))
    assert {r["doc_id"]: (r["__words"], r["__removed"], r["text"] or "") for r in got} == want
    assert sum(x[1] for x in want.values())


def test_remove_repeats_with_repeated_rows(docs):
    got = [r for r in local(substring_dedup.remove_repeats(docs)) if r["doc_id"] == 6]
    assert sorted(r["__removed"] for r in got) == [0, got[0]["__words"]]


@pytest.mark.parametrize("step", ["anchors", "extended"])
def test_words_of_earlier_texts_are_not_kept(step):
    """The memory of a task of op4 does not grow with the words it has seen."""

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    def batches():
        for n in range(100):
            texts = [" ".join(f"w{n}-{k}-{w}" for w in range(100)) for k in range(20)]
            seeds = pa.array([[0]] * 20, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array(texts), seeds], ["doc", "text", "seeds"])

    run = getattr(substring_dedup, f"_{step}")(Rows(), substring_dedup.Repeats())
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in run(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (found > 0) == (step == "anchors")
    assert peak < 8 << 20  # 200,000 words: over 20 MB when kept


def test_winnow_leaves_no_run_without_anchor():
    x = np.random.default_rng(1).integers(0, 50, 400).astype(np.uint64)
    at = substring_dedup.winnow(x, 11)
    assert all(any(lo <= a < lo + 11 and x[a] == x[lo : lo + 11].min() for a in at) for lo in range(390))


# -- quality -----------------------------------------------------------------------------------------


def brute_metrics(text):
    words, covered = WORD.findall(text), set()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    for i, g in enumerate(grams):
        covered |= {i, i + 1, i + 2} if n[g] > 1 else set()
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality(docs):
    got = local(quality.judge(docs))
    assert len(got) == docs.count()
    for r in got:
        want = brute_metrics(r["text"] or "")
        assert tuple(r[m] for m in quality.METRICS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and (r["host_rate"] or 0) <= 0.5)
        assert (r["host_rate"] is None) == (r["source"] is None)


def test_host_rules(spark):
    """A host whose documents nearly all fail takes the rest with it; one failure does not."""
    good = " ".join(f"g{i}" for i in range(60))
    rows = [(i, good, f"h{i % 20}") for i in range(400)] + [(1000 + i, "short", "bad") for i in range(200)] + [(2000, good, "bad"), (2001, "short", "h1")]
    got = {r["doc_id"]: r["kept"] for r in local(quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")))}
    assert not got[2000] and all(got[i] for i in range(400))


# -- mixing ------------------------------------------------------------------------------------------


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i % 50)), "big" if i % 10 else f"s{i % 30}") for i in range(3000)] + [(None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.Mixture(entropy=0.9, repetition=3.0, block_tokens=5_000)
    got = local(mixing.mixed(frame, mix))
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    shown, have = Counter(), Counter()
    for r in got:
        shown[r["source"]] += r["tokens"]
    for _, t, s in rows:
        have[s] += len((t or "").split()) + 1
    weights = {r["source"]: r["weight"] for r in local(mixing.weigh(frame.select("source", mixing.count_tokens(F.coalesce("text", F.lit(""))).alias("tokens")), mix))}
    total = sum(shown.values())
    for s in ("big", "s0", "s10", "s20"):
        assert abs(shown[s] / total - weights[s]) < 0.01
    times = {s: shown[s] / have[s] for s in have}
    assert min(times.values()) >= 1 and max(times.values()) / min(times.values()) < 3.3
    blocks = defaultdict(list)
    for r in got:
        blocks[r["block"]].append(r)
    for rows_of in blocks.values():
        assert sorted(r["place"] for r in rows_of) == list(range(1, len(rows_of) + 1))
        assert sum(r["tokens"] for r in rows_of) <= 5_000 + 4 * 51


# -- WARC --------------------------------------------------------------------------------------------


def test_warc(spark):
    big, rows = "<p>é" * 400, []
    for i in range(60):
        rows.append((i, f"http://h{i % 5}.example.com:80/p{i % 50}?q={i}" if i % 9 else None, big if i % 4 == 0 else ("" if i % 7 else None) if i % 3 else f"page {i}"))
    frame = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string").withColumn("payload_bytes", F.lit("x")).repartition(4)
    files = warc.write_archives(frame, work_folder(spark, "warc"), block_lines=3)
    want = Counter()
    last = max(i for i, _, h in rows if h == big)
    for i, url, html in [*rows, rows[0]]:
        body = (html or "").encode()
        refers = last if html == big and i != last else None
        want[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers, url)] += 1
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["url"]) for r in local(warc.read_archives(files)))
    assert got == want
    found = local(warc.find_captures(files, frame.select("url").filter("url is not null").limit(10).unionByName(spark.createDataFrame([("http://nowhere/",)], "url string"))))
    assert found and all(r["payload"] == (dict((i, h) for i, _, h in rows)[r["page_id"]] or "").encode() for r in found if r["record_type"] == "response")


# -- URLs --------------------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = url_filter.rule_table(spark, [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/fr/")])
    urls = {
        "http://a.com/x": ("a.com", "/x", "com/", "allow"),
        "https://m.EXAMPLE.com/en/1?q": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1#f": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://notnet/fr/": ("notnet", "/fr/", None, "allow"),
        "http://x.net/fr": ("x.net", "/fr", None, "allow"),
        "http://com?x://y/": ("com", "", None, "allow"),
        "nothing": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    frame = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in local(url_filter.judge(frame, rules))}
    assert got == dict(enumerate(urls.values()))


def test_propagation_is_personalised_rank(spark):
    rng = np.random.default_rng(4)
    edges = {(f"h{a}", f"h{b}"): int(n) for a, b, n in rng.integers(0, 8, (30, 3)) if a != b and n}
    config = url_filter.Propagation(rounds=5)
    frame = spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h1", 1.0), ("h2", 0.5)], "host string, mass double")
    score = start = {"h1": 0.15, "h2": 0.075}
    out = Counter()
    for (a, _), n in edges.items():
        out[a] += n
    for _ in range(5):
        new = Counter(start)
        for (a, b), n in edges.items():
            new[b] += 0.85 * score.get(a, 0) * n / out[a]
        score = new
    got = {r["host"]: r["score"] for r in local(url_filter.personalised_rank(frame, seeds, config))}
    assert got == pytest.approx({k: v for k, v in score.items() if k in got}) and set(got) >= {k for k, v in score.items() if v}


def test_suspect_neighbours_are_blocked(spark):
    rules = url_filter.rule_table(spark, [("block", "bad.org", "/"), ("allow", "good.org", "/")])
    rows = [(1, "http://spam.org/", "<a href='http://bad.org/x'>"), (2, "http://bad.org/x", None), (3, "http://fine.org/", "<a href=//good.org/>"), (4, "http://good.org/", "<a href='http://fine.org/y'>")]
    got = {r["page_id"]: r["verdict"] for r in local(url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules))}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_links_of_every_attribute_and_of_domains(spark):
    html = """<base target=_top><a href=//a.org/x>1</a><IMG src='https://b.org/i.png' srcset="//c.org/1 1x, /own 2x"><a href="/own?u=http://no.org/">
    <form action="http://d.org"></form><meta http-equiv=refresh content="3; url=http://e.org/"><svg xmlns="http://no.org/"><!-- <a href="http://no.org"> -->
    <script src="//f.org/s.js">var u="http://no.org/";</script><a title="see http://no.org">"""
    rows = [(1, "http://h.org/", html), (2, "http://i.org/", "<base href='http://j.org/'><a href=x><a href='#top'>"), (3, None, html)]
    got = {(r["src"], r["dst"], r["n"]) for r in local(url_filter.links(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert got == {("h.org", f"{x}.org", 1) for x in "abcdef"} | {("i.org", "j.org", 2)}
    hosts = spark.createDataFrame([(h,) for h in ("blog.x.example.net", "m.x.example.net", "y.org", "com", "", "10.0.0.1")], "host string")
    up = {("blog.x.example.net", "x.example.net"), ("m.x.example.net", "x.example.net"), ("x.example.net", "example.net")}
    assert {(r["src"], r["dst"]) for r in local(url_filter.kin(hosts))} == up | {(b, a) for a, b in up}


def brute_parts(edges, mass, damping=0.85):
    """Part of each host's personalised rank, by solving for it; ``edges`` is (src, dst) -> weight."""
    hosts = sorted({h for e in edges for h in e} | set(mass))
    at = {h: k for k, h in enumerate(hosts)}
    share = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in edges.items():
        share[at[b], at[a]] = n
    share /= np.where(share.sum(axis=0) > 0, share.sum(axis=0), 1)
    own = np.array([mass.get(h, 0.0) for h in hosts])
    rank = lambda m: np.linalg.solve(np.eye(len(hosts)) - damping * share, (1 - damping) * m)
    got, most = rank(own) - (1 - damping) * own, rank(np.ones(len(hosts))) - (1 - damping)
    part = [(1 - damping) * m + damping * g / w if w > 1e-6 else m for m, g, w in zip(own, got, most, strict=True)]
    return dict(zip(hosts, part, strict=True))


def test_distrust_does_not_depend_on_the_number_of_linkers(spark, monkeypatch):
    """A chain longer than eight links, and 30 hosts that link to the chain's blocked end."""
    edges = {(f"c{k + 1}", f"c{k}"): 1 for k in range(11)} | {(f"s{k}", "c0"): 2 for k in range(30)}
    frame = spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long")
    none, seed = spark.createDataFrame([], "host string, mass double"), spark.createDataFrame([("c0", 1.0)], "host string, mass double")
    want = brute_parts({(b, a): n for (a, b), n in edges.items()}, {"c0": 1.0})
    got = local(url_filter.propagate(frame, none, seed, url_filter.Propagation(tolerance=1e-9)))
    assert {r["host"]: r["distrust"] for r in got} == pytest.approx(want, abs=1e-6)
    assert {r["host"] for r in got if r["blocked"]} == {"c0", "c1", *(f"s{k}" for k in range(30))}
    against, few = frame.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"), url_filter.Propagation(rounds=2)
    want = {r["host"]: r["score"] for r in local(url_filter.personalised_rank(against, seed, few))}
    monkeypatch.setattr(url_filter, "GRAPH_BYTES", -1)  # a graph too large for one task
    got = {r["host"]: r["score"] for r in local(url_filter.personalised_rank(against, seed, few))}
    assert got == pytest.approx({h: want[h] for h in got}) and set(got) >= {h for h, x in want.items() if x}


def test_judge_equals_brute_force(spark):
    """Rules, links and domains together, with hosts partly blocked and pages no rule fits."""
    rng = np.random.default_rng(17)
    hosts = [f"{p}h{k}.{t}" for k, (p, t) in enumerate(itertools.product(("", "www.", "a.b."), ("good.org", "bad.net", "mid.net", "else.io")))]
    rules = [("allow", "good.org", "/"), ("block", "bad.net", "/"), ("block", "net", "/x/"), ("allow", "www.h6.mid.net", "/x/")]
    rows, edges = [], Counter()
    for i in range(150):
        src, to = hosts[rng.integers(len(hosts))], [hosts[k] for k in rng.integers(0, len(hosts), rng.integers(0, 3))]
        rows.append((i, f"http://{src.upper() if i % 2 else src}/{'x' if rng.random() < 0.7 else 'y'}/{i}", " ".join(f"<a href='//{h}/z'>" for h in to) or None))
        edges.update((src, h) for h in to if h != src)
    rows += [(150, None, "<a href=//nowhere.io>"), (151, "no address", None), (152, "http://sink.bad.net/x/", None), (153, "http://spam.io/y/", "<a href='//sink.bad.net/z'>"), rows[0]]
    edges["spam.io", "sink.bad.net"] += 1
    split = lambda u: re.match(r"[^:]*://([^/]*)(.*)", u or "").groups() if "://" in (u or "") else ("", "")
    edges.update((rows[0][1][7:].split("/")[0].lower(), h) for h in re.findall("//([^/]*)/z", rows[0][2] or "") if h != rows[0][1][7:].split("/")[0].lower())

    def rule(host, path):
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda f: (f[0], f[1] == "allow"))[1:] if fits else (None, None)

    judged = [(i, split(u)[0].lower(), split(u)[1]) for i, u, _ in rows]
    seen = Counter(h for _, h, _ in judged if h)
    mass = {v: {h: n / seen[h] for h, n in Counter(h for _, h, p in judged if rule(h, p)[0] == v).items()} for v in ("allow", "block")}
    for child, parent in {(".".join(h.split(".")[k:]), ".".join(h.split(".")[k + 1 :])) for h in seen for k in range(h.count(".") - 1)}:
        edges[child, parent] += 0.25
        edges[parent, child] += 0.25
    for v in ("allow", "block"):
        mass["allow" if v == "block" else "block"] |= {h: mass["allow" if v == "block" else "block"].get(h, 0.0) for h in mass[v]}
    trust, distrust = brute_parts(edges, mass["allow"]), brute_parts({(b, a): n for (a, b), n in edges.items()}, mass["block"])
    got = local(url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), url_filter.rule_table(spark, rules)))
    want = Counter()
    for i, h, p in judged:
        verdict, text = rule(h, p)
        bad = h and distrust[h] >= 0.5 and distrust[h] > trust[h]
        want[i, h, p, text, verdict or ("block" if bad else "allow")] += 1
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want
    assert {r["host"]: r["distrust"] for r in got if r["host"]} == pytest.approx({h: distrust[h] for h in seen}, abs=1e-4)
    assert {r["host"]: r["trust"] for r in got if r["host"]} == pytest.approx({h: trust[h] for h in seen}, abs=1e-4)
    assert any(r["rule"] is None and r["verdict"] == "block" for r in got) and any(r["rule"] is None and r["verdict"] == "allow" for r in got)


# -- nearest neighbours ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16)) + 3 * rng.normal(size=(6, 16))[rng.integers(0, 6, 600)]
    x[100:160] = x[100]
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(x)]
    bad = [(1000, None, 1), (1020, [0.0] * 16, 1), (1040, [float("nan")] * 16, 1), (1060, [None] * 16, 1), (1080, [1.0] * 3, 1), (1100, [float("inf")] * 16, 1)]
    return spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x")), x.astype(np.float32).astype(float)


@pytest.mark.parametrize("chunk", [50, 4096])
def test_search(vectors, monkeypatch, chunk):
    monkeypatch.setattr(ann, "CHUNK", chunk)
    frame, x = vectors
    by = defaultdict(list)
    for r in sorted(local(ann.search(frame)), key=lambda r: r["rank"]):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 600, 20))
    hits = 0
    for q, got in by.items():
        scores = ann.exact_scores(x[q], x)
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        assert [s for _, s in got] == [scores[i] for i, _ in got] and got == sorted(got, key=lambda p: (-p[1], p[0])) and len(got) == 20
        hits += len({i for _, i in want} & {i for i, _ in got})
    assert hits >= 0.9 * 20 * len(by)


def test_search_sends_a_query_once_to_a_part(vectors, monkeypatch):
    """However many groups there are, a query travels to each part at most once, and tasks hold slices of the queries."""
    frame, _ = vectors
    want = sorted(tuple(r) for r in local(ann.search(frame, ann.Search(hashes=8))))
    sent, real = [], ann._met

    def met(visits, members, *args):
        sent.append((Counter((r["t"], r["id"]) for r in local(visits.select("t", "id"))), sum(r["n"] for r in local(members.groupBy("t", "part").count().withColumnRenamed("count", "n"))), members.select("t", "part").distinct().count()))
        return real(visits, members, *args)

    monkeypatch.setattr(ann, "_met", met)
    monkeypatch.setattr(ann, "VALUES", 16 * 7)
    assert sorted(tuple(r) for r in local(ann.search(frame, ann.Search(hashes=8)))) == want
    monkeypatch.setattr(ann, "CHUNK", 8)
    assert local(ann.search(frame, ann.Search(hashes=8)))
    visits, n, parts = sent[1]
    assert n == 2 * 600 and parts <= 2 * 65 and max(visits.values()) <= 65


def test_meeting_by_blocks(monkeypatch):
    """Queries and vectors that come in many batches give what one comparison of all gives, ties by id."""
    monkeypatch.setattr(ann, "BLOCK", 37)
    monkeypatch.setattr(ann, "_FIRST", 5)
    monkeypatch.setattr(ann, "_SLICE", 4)
    monkeypatch.setattr(ann, "_SCORES", 3)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)).astype(np.float32) * np.float32(10) ** rng.integers(-6, 3, (300, 1)).astype(np.float32)
    x[40:90] = x[40]
    length = float(np.sqrt((x.astype(float) ** 2).sum(axis=1)).max())

    def batch(part, ids, least):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array([0] * n, pa.int32()),
             pa.array(ids, pa.int64()), pa.array([least] * n, pa.float64()), pa.array([x[i].tolist() for i in ids], pa.list_(pa.float32()))],
            ["t", "part", "chunk", "slice", "id", "least", "v"],
        )

    came, asked = [], {0: list(range(0, 300, 20)), 1: list(range(0, 300, 30))}
    for part, ids in asked.items():
        came += [batch(part, ids[:7], 0.0), batch(part, ids[7:], 0.0)]
        came += [batch(part, list(range(lo, min(lo + 90, 300))), None) for lo in range(part * 100, 300, 90)]
    got = Counter(tuple(r.values()) for b in ann._meetings(iter([pa.Table.from_batches(came).combine_chunks().to_batches()[0]]), 6, 5, length, None) for r in b.to_pylist())
    assert got == Counter(tuple(r.values()) for b in ann._meetings(iter(came), 6, 5, length, None) for r in b.to_pylist())
    want = Counter()
    for part, ids in asked.items():
        for q in ids:
            scores = ann.exact_scores(x[q].astype(float), x.astype(float))
            want.update((q, i, s) for s, i in sorted(((s, i) for i, s in enumerate(scores) if i != q and i >= part * 100), key=lambda p: (-p[0], p[1]))[:5])
    assert got == want


def test_few_candidates_are_all_returned(spark):
    frame = spark.createDataFrame([(20, [1.0, 2.0]), (21, [-1.0, 0.5]), (40, [3.0, -4.0])], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in local(ann.search(frame))}
    assert got == {(20, 1): 21, (20, 2): 40, (40, 1): 20, (40, 2): 21}


# -- empty tables ------------------------------------------------------------------------------------


def test_empty_tables_give_no_rows(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    rules = url_filter.rule_table(spark, [("block", "net", "/")])
    for frame in (
        packing.pack_documents(empty, BYTE_BPE), token_files.write_and_read(empty, WORD_BPE), line_dedup.dedup_lines(empty),
        near_dedup.near_duplicates(empty), near_dedup.keep_one(empty), substring_dedup.remove_repeats(empty), quality.judge(empty),
        mixing.mixed(empty), warc.write_and_read(pages), url_filter.judge(pages, rules), ann.search(vectors),
    ):
        assert frame.count() == 0
