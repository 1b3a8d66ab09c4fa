"""Token counts against the file's own library; collocations and ranked
search against brute force; the double-array trie against a dict."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helixframe.llm import collocations as C
from helixframe.llm import lexical_search as S
from helixframe.llm import token_counts as T
from helixframe.llm.common import lower_ascii
from helixframe.llm.double_array import DoubleArray

EDGE = ["'", " ", "s", "re", "ve", "ll", "d", "m", "t", "r", "l", "the", "\n", "\t", " ", "1", "23", "!", "é", "漢", "😀",
        "<|endoftext|>", "  ", "ing", "́", "\x00", "<|", "v", "e", "\x0b", "²"]


# -- the trie
@pytest.mark.parametrize("alphabet", [b"ab", bytes(range(256))])
def test_double_array_finds_exactly_its_keys(alphabet):
    rnd = random.Random(3)
    word = lambda: bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9)))
    keys = list({word() for _ in range(3000)})
    trie = DoubleArray.of(keys)
    asked = keys + [word() for _ in range(3000)] + [b""]
    ends = np.cumsum([len(k) for k in asked])
    data = np.frombuffer(b"".join(asked), dtype=np.uint8)
    number = {k: i for i, k in enumerate(keys)}
    found = trie.find(data, np.concatenate([[0], ends[:-1]]), ends)
    assert found.tolist() == [number.get(k, -1) for k in asked]


def test_double_array_without_keys():
    trie = DoubleArray.of([])
    assert trie.find(np.frombuffer(b"a", dtype=np.uint8), np.array([0]), np.array([1])).tolist() == [-1]


# -- op11
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER))


@pytest.fixture(scope="module")
def bpe():
    return T.load_bpe()


def expected(library, texts):
    return [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_those_of_the_library(library, bpe):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(EDGE) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    assert T.TokenCounter(bpe).count(texts).tolist() == expected(library, texts)


def test_every_code_point_has_the_library_s_class(library, bpe):
    pre, classes = library.pre_tokenizer, bpe["classes"]
    letters, numbers, blanks = (T.LETTER, T.STMD, T.RV, T.E, T.ELL), (T.NUMBER,), (T.SPACE, T.BLANK)
    for lo in range(0, 0x30000, 1 << 15):
        chars = [chr(p) for p in range(lo, lo + (1 << 15)) if not 0xD800 <= p < 0xE000]
        if not chars:
            continue
        starts = {base: T._starts_after(pre, base, chars) for base in "a1!"}
        for c in chars:
            kind = int(classes[ord(c)])
            assert (c not in starts["a"]) == (kind in letters), hex(ord(c))
            assert (c not in starts["1"]) == (kind in numbers), hex(ord(c))
            assert (c in starts["!"] and kind not in letters + numbers) == (kind in blanks), hex(ord(c))


def test_chunk_maps_compose_to_one_run(bpe):
    rnd = random.Random(7)
    classes = np.array([rnd.randrange(11) for _ in range(5000)], dtype=np.uint8)
    splitter = T.Splitter(bpe["classes"])
    whole_run = splitter.starts(classes, size=len(classes))
    for size in (1, 2, 3, 64, 700):
        assert (splitter.starts(classes, size) == whole_run).all()
    state, marks = T.START, np.zeros(len(classes) + 1, dtype=bool)
    for k, c in enumerate(classes):
        m = splitter.marks[state, c]
        marks[k] |= bool(m & T.HERE)
        marks[k - 1] |= bool(m & T.BEFORE)
        state = splitter.to[state, c]
    assert (whole_run == marks[:-1]).all()


def test_counts_do_not_hang_on_chunks_or_on_states_kept(library, bpe, monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcdefgh ' \n") for _ in range(rnd.randint(0, 300))) for _ in range(300)]
    want = expected(library, texts)
    monkeypatch.setattr(T, "STATES", 50)
    counter = T.TokenCounter(bpe)
    for size in (1, 7, 10_000):
        monkeypatch.setattr(T.Counter.counts, "__defaults__", (size,))
        assert [int(n) for part in T._together(texts, 2000) for n in counter.count(part)] == want


def test_long_runs_without_a_border(library, bpe):
    rnd = random.Random(11)
    texts = ["a" * 20_000, " " * 20_000 + "x", "=-" * 9_000, "".join(rnd.choice("abcdefghij") for _ in range(20_000))]
    assert T.TokenCounter(bpe).count(texts).tolist() == expected(library, texts)


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        T.load_bpe("word_bpe_49k.json")


def test_count_tokens_on_odd_rows(spark, odd, empty, library):
    got = T.count_tokens(odd)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    n = expected(library, [t for _, t in texts])
    want = [(i, len(t.encode()), k, k > 1024) for (i, t), k in zip(texts, n)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert T.count_tokens(empty).collect() == []


# -- op12
def brute_collocations(rows, least, top):
    out, by_lang = [], {}
    for lang, text in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for t in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(t)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * found[q]}
        ranked = []
        for p, a in found.items():
            if p not in held:
                s, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def texts_of(spark, rows):
    return spark.createDataFrame([(k, t, lang, "x", 1) for k, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, word string, a int")


def some_texts():
    rnd = random.Random(13)
    words = ["The", "of", "x", "é", "über", "a-b", "'s", "1", "漢", "#", "long" * 9]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; "]
    rows = [(rnd.choice(["en", "de", None, "und", ""]), "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randint(0, 60))))
            for _ in range(150)]
    return rows + [("en", None), ("en", ""), ("en", " . "), ("en", "The of x " * 4000)] + rows[:20]


@pytest.mark.parametrize("how", [{}, {"together": 7, "shards": 10**6}, {"words_bound": 0}, {"phrases_bound": 3}, {"shards": 0}])
def test_collocations_by_every_way(spark, how):
    rows = some_texts()
    got = C.collocations(texts_of(spark, rows), top=40, **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 10, 40)


def test_collocations_that_no_bucket_may_lose(spark, monkeypatch):
    monkeypatch.setattr(C, "FEWEST_BUCKETS", 3)
    monkeypatch.setattr(C, "MOST_BUCKETS", 3)
    monkeypatch.setattr(C, "_BLOCK", 8)
    monkeypatch.setattr(C, "_SLICE", 8)
    rows = some_texts()
    got = C.collocations(texts_of(spark, rows), least=4, top=10**6)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 4, 10**6)


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(C, "_word_hashes", lambda data, begin, end: np.zeros(len(begin), dtype=np.uint64))
    words = C.Words(["a bc. a", "", "bc dd"])
    assert words.distinct().to_pylist() == ["a", "bc", "dd"]
    assert words.number.tolist() == [0, 1, 0, 1, 2]
    assert words.cells().tolist() == [0, 1, -1, 0, -1, 1, 2, -1]


def test_collocation_scores_beyond_64_bits(spark):
    one = spark.createDataFrame([(3_000_000_000_000, 3_100_000_000_000, 3_200_000_000_000)], "a long, l long, r long")
    a, left, right = 3_000_000_000_000, 3_100_000_000_000, 3_200_000_000_000
    from pyspark.sql import functions as F
    assert one.select(C._score("a", F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


def test_collocations_of_nothing(spark, empty):
    assert C.collocations(empty).collect() == []
    assert C.collocations(texts_of(spark, [("en", "one two three")])).collect() == []


# -- op13
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, best=20):
    held = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := TERM.findall(lower_ascii(t or "")))]
    nd, nt, df = len(held), sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        times = Counter(TERM.findall(lower_ascii(text or "")))
        w = {t: k * math.floor(1000 * math.log((2 * nd + 2) / (2 * df[t] + 1))) for t, k in times.items()}
        ranked = []
        for i, c, n in held:
            m = 75 + (25 * n * nd) // nt
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in w if t in c)
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        ranked.sort(key=lambda x: x[:3])
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(ranked[:best])]
    return sorted(out, key=repr)


def searched(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0, 0, "x") for i, t in docs], "doc_id long, text string, score int, rank int, item_id string")
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = S.search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def some_search():
    rnd = random.Random(17)
    words = ["The", "of", "Übung", "über", "x1", "漢字", "a_b", "rare%d", "\x00", "é"]
    say = lambda n: " ".join(rnd.choice(words).replace("%d", str(rnd.randint(0, 50))) for _ in range(n))
    docs = [(k, say(rnd.randint(0, 30))) for k in range(400)]
    docs += [(1000 + k, "the same text") for k in range(60)] + docs[:30]  # ties, repeated rows
    docs += [(None, "the same text"), (None, "über alles"), (7, None), (8, ""), (9, " .-"), (10, "word over " * 20_000)]
    rnd.shuffle(docs)
    items = [(k, say(rnd.randint(1, 12))) for k in range(80)]
    return docs, items + [(100, "the same text same"), (101, None), (102, ""), (103, "nowhere"), (104, "over " * 3000)]


def test_search_is_brute_force(spark):
    docs, items = some_search()
    assert searched(spark, docs, items) == brute_search(docs, items)


def test_search_in_small_blocks_and_tiles(spark, monkeypatch):
    docs, items = some_search()
    monkeypatch.setattr(S, "BLOCK_ITEMS", 30)
    monkeypatch.setattr(S, "TILE_DOCS", 17)
    monkeypatch.setattr(S.item_tiles, "__defaults__", (5, 3, 1 << 40))
    assert searched(spark, docs, items) == brute_search(docs, items)


def test_item_tiles_keep_sums_exact():
    weights = np.array([21_000, 3, 900])
    tiles = S.item_tiles([np.array([0] * 1000 + [1, 2]), np.array([2])], weights, size=2, cells=10, exact=1 << 40)
    total = np.zeros((2, 3))
    for terms, weight in tiles[0][1]:
        assert (weight.sum(axis=1) * 10**6 < 1 << 40).all()
        for column, term in enumerate(terms):
            total[:, term] += weight[:, column]
    assert total.tolist() == [[21_000_000, 3, 900], [0, 0, 900]]


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, "a")], [(1, None)]) == []


def test_items_under_one_id_have_ranks_of_their_own(spark):
    got = searched(spark, [(1, "red"), (2, "blue")], [(5, "red"), (5, "blue"), (None, "red")])
    assert [r[:3] for r in got] == [(5, 1, 1), (5, 1, 2), (None, 1, 1)]


def test_counts_travel_as_planes_of_bytes():
    n = np.array([0, 1, 255, 256, 2 ** 40 + 7, 0], dtype=np.int64)
    assert C._from_planes(C._planes(n)).tolist() == n.tolist()
    assert C._planes(n)[:3] == b"\0\1\xff"
    assert C._from_planes(b"").tolist() == []
