"""The training-data operators against brute force on small fixtures with odd rows."""

import hashlib
import pickle
import random
import re
import weakref
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pixelframe.llm import bpe, decontamination, induced, jaccard, kernels, language, quality, queries, revisits, substring_dedup, suffix_dedup, toxicity, wordpiece

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, id string, th string, row int, q int, n int, h int"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


WORDS_300 = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "rst", "ll", "mp", "x", "ck", "sh", "th", "v", "z", "d", "g")]


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, base = make(40), make(120).split()
    out = [None, "", "   \n\t ", "one", "One two", "a b c d", make(4), make(5), make(13), shared, shared, shared.upper()]
    out += [make(rng.randint(5, 80)) + " " + shared + "\n" + make(rng.randint(0, 60)) for _ in range(8)]
    for k in (1, 2, 3, 12):  # near copies, the last one too far
        w = list(base)
        for _ in range(k):
            w[rng.randrange(len(w))] = "changed" + str(rng.random())
        out.append(" ".join(w))
    out += ["same " * 300, "x" * 5000, make(3000), "日本語 テキスト 😀 " * 30, "tab\tand\x0bother\x0cspaces \x1c\x85 kept", "<|endoftext|> I'm here, don't <|endoftext|>"]
    out += [make(rng.randint(1, 60)) for _ in range(15)]
    return out


@pytest.fixture(scope="module")
def rows():
    t = texts()
    out = [(i, x, "en", "s", "a", "b", 1, 2, 3, 4) for i, x in enumerate(t)]
    out += [out[9], out[25]]  # repeated rows
    out += [(7, t[14], "fr", None, None, None, None, None, None, None)]  # a repeated id
    out += [(None, t[15], None, None, None, None, None, None, None, None)]  # no id
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(found):
    return Counter(map(tuple, found))


def test_substring_dedup(docs, none, rows):
    low = lambda i: 1 << 62 if i is None else i
    first = defaultdict(lambda: 1 << 63)
    for r in rows:
        w = spaced(r[1])
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first[key], low(r[0]))
    want = []
    for r in rows:
        w = spaced(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < low(r[0]):
                gone[k : k + 13] = [True] * 13
        want.append((r[0], r[1], len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = substring_dedup.substring_dedup(docs)
    assert multiset(got.select("row.doc_id", "row.text", "n_words", "n_removed", "kept").collect()) == multiset(want)
    longest = {r["doc_id"]: r["longest_repeat"] for r in got.where("row.doc_id IS NOT NULL").select("row.doc_id", "longest_repeat").collect()}
    assert longest[3] == 0 and longest[9] == longest[10] == 26
    assert substring_dedup.substring_dedup(none).count() == 0


def test_substring_dedup_marks_in_few_tasks(spark, monkeypatch):
    """Each task that marks keys makes a whole bitmap, so the keys of all levels come in few partitions."""
    seen, real = [], substring_dedup.bitmap
    monkeypatch.setattr(substring_dedup, "bitmap", lambda keys, *a: seen.append(keys.rdd.getNumPartitions()) or real(keys, *a))
    shared = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, shared), (2, "a " + shared), (3, "other words")], "doc_id long, text string")
    out = {r["row"]["doc_id"]: (r["n_removed"], r["longest_repeat"]) for r in substring_dedup.substring_dedup(docs).collect()}
    assert out == {1: (0, 52), 2: (60, 52), 3: (0, 0)}
    assert len(seen) == 2 and max(seen) <= 16


def test_first_level_sends_low_bytes(docs, monkeypatch):
    t = pa.array([" ".join(f"w{i % 9}{i}" for i in range(400))] * 2)
    one = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([5, 6]), t], ["id", "th", "text"])
    ranges = 16
    made = [r for b in substring_dedup.from_text(7, ranges, 4, substring_dedup.FIRST_BYTES)(iter([one])) for r in b.to_pylist() if r["dest"] < ranges]
    assert sum(len(r["hashes"]) for r in made) == 394 * substring_dedup.FIRST_BYTES < 394 * 8
    h = np.array([0, 1, 255, 1 << 40, (1 << 64) - 1], np.uint64)
    for k in (1, 5, 8):
        assert (substring_dedup.from_low(substring_dedup.low_bytes(h, k), k) == h & np.uint64((1 << 8 * k) - 1)).all()
    want = multiset(tuple(r) for r in substring_dedup.substring_dedup(docs).drop("row").collect())
    monkeypatch.setattr(substring_dedup, "FIRST_BYTES", 1)  # nearly all windows become candidates by chance
    assert multiset(tuple(r) for r in substring_dedup.substring_dedup(docs).drop("row").collect()) == want


def test_levels_leave_little_behind(spark, monkeypatch):
    """Of a level only short rows are kept to the end; its blocks go before its candidates are sent."""
    events, plain, level = [], substring_dedup.cut, substring_dedup.next_level

    def cut(df):
        events.append("state" if "positions" in df.columns else "done" if "flagged" in df.columns else "blocks" if "rep" in df.columns else "other")
        return plain(df)

    def next_level(*a):
        events.append("level")
        return level(*a)

    monkeypatch.setattr(substring_dedup, "cut", cut)
    monkeypatch.setattr(substring_dedup, "next_level", next_level)
    monkeypatch.setattr(substring_dedup, "release", lambda s, rounds=2: events.append("release"))
    text = " ".join(f"w{i}" for i in range(120))
    d = spark.createDataFrame([(1, text), (2, "start " + text), (3, "other words"), (4, text[:200] + " between " + text[200:])], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.substring_dedup(d).select("row.doc_id", "n_words", "n_removed", "longest_repeat").collect()}
    assert got[1] == (120, 0, 104) and got[2] == (121, 120, 104) and got[3] == (2, 0, 0)
    levels = " ".join(events).split("level ")[1:]
    assert len(levels) == 4 and all(x.split()[:5] == ["blocks", "release", "state", "done", "release"] for x in levels)
    at = np.array([0, 1, 2, 7, 9, 10], np.int64)
    assert substring_dedup.from_runs(substring_dedup.runs(at)).tolist() == at.tolist()
    assert len(substring_dedup.runs(np.arange(5, 5000))) == 8 and not substring_dedup.runs(at[:0])


def test_suffix_dedup(docs, none, rows):
    for length in (64, 200):
        seen = Counter(b[i : i + length] for r in rows for b in [(r[1] or "").encode()] for i in range(len(b) - length + 1))
        want = []
        for r in rows:
            b = (r[1] or "").encode()
            gone = np.zeros(len(b), bool)
            for i in range(len(b) - length + 1):
                if seen[b[i : i + length]] > 1:
                    gone[i : i + length] = True
            left = bytes(x for x, g in zip(b, gone) if not g)
            want.append((r[0], r[1], len(b), int(gone.sum()), len(kernels.runs(gone)[0]), sha(left)))
        got = suffix_dedup.suffix_dedup(docs, length=length, keep_text=False)
        assert multiset(got.select("row.doc_id", "row.text", "n_bytes", "n_removed", "n_spans", "kept").collect()) == multiset(want)
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_hot_windows_take_one_pass(monkeypatch):
    rng = random.Random(6)
    text = pa.array([" ".join(rng.choice(["aa", "b", "cde", "f g"]) for _ in range(120)) for _ in range(6)])
    buf, offsets = suffix_dedup.K.text_buffer(text)
    _, _, c, g, _, split = suffix_dedup.segments(buf, offsets, 32)
    assert not split.any()
    hot = suffix_dedup.Bitmap(np.zeros(1 << 13, np.uint8))
    hot.add(g[::3])
    want = sum(c[hot.marked(g)].tolist())
    passes, plain = [], suffix_dedup.segments
    monkeypatch.setattr(suffix_dedup, "segments", lambda *x: passes.append(1) or plain(*x))
    got = list(suffix_dedup.key_counts(32, 16, hot)(iter([pa.RecordBatch.from_arrays([text], ["text"])])))
    assert len(passes) == 1 and want > 100
    contents = np.frombuffer(b"".join(x for b in got for x in b.column("contents").to_pylist()), np.int32)
    _, s, _, _, d, single = plain(buf, offsets, 32, hot)
    assert int(single.sum()) == want and int(contents.sum()) == len(np.unique(d[single]))


def test_induced_sorting():
    rng = random.Random(7)
    for _ in range(150):
        letters = rng.choice(["a", "ab", "abcdefgh"])
        strings = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))).encode() for _ in range(rng.randint(1, 6))]
        weights, length = np.array([rng.choice([1, 1, 2]) for _ in strings]), rng.choice([1, 2, 5, 20])
        seen = Counter()
        for s, w in zip(strings, weights.tolist()):
            for i in range(len(s) - length + 1):
                seen[s[i : i + length]] += w
        sizes = np.array([len(x) for x in strings])
        # a limit of 0: all arrays are files; small steps: waves and buckets of many chunks
        hit = induced.repeated(np.frombuffer(b"".join(strings), np.uint8), sizes, weights, length, limit=rng.choice([0, 500, 1 << 20]), step=rng.choice([3, 16, 1 << 10]))
        ends = np.cumsum(sizes + 1) - 1
        assert [hit[a : max(a, b - length + 1)].tolist() for a, b in zip(ends - sizes, ends)] == [[seen[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]


def clusters(rows):
    sets = []
    for r in rows:
        w = spaced((r[1] or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]) and sets[j]:
                parent[find(i)] = find(j)
    low = lambda i: (rows[i][0] is None, rows[i][0])
    best = {}
    for i in range(len(rows)):
        best[find(i)] = min(best.get(find(i), low(i)), low(i))
    return [(rows[i][0], rows[i][1], len(sets[i]), best[find(i)][1] if sets[i] else rows[i][0]) for i in range(len(rows))]


def test_jaccard(docs, none, rows):
    got = jaccard.jaccard_components(docs).select("row.doc_id", "row.text", "n_shingles", "component_id")
    assert multiset(got.collect()) == multiset(clusters(rows))
    assert jaccard.jaccard_components(none).count() == 0


def test_jaccard_many_near_copies(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    out = []
    for i in range(300):  # each changes a few of the same text's words: chains as well as a core
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(80)] = f"x{rng.random()}"
        out.append((i, " ".join(w), "en", "s", "a", "b", 1, 2, 3, 4))
    got = jaccard.jaccard_components(spark.createDataFrame(out, SCHEMA).repartition(4)).select("row.doc_id", "row.text", "n_shingles", "component_id")
    assert multiset(got.collect()) == multiset(clusters(out))


def test_jaccard_families(spark):
    """Near copies that mostly don't link: their columns are hot and their sets multiplied whole."""
    rng = random.Random(2)
    out, base = [], [f"w{i}" for i in range(200)]
    for i in range(260):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 4, 5, 5, 6])):
            w[rng.randrange(200)] = f"x{rng.random()}"
        out.append((i, " ".join(w[: rng.choice([200, 200, 190, 170])]), *[None] * 8))
    d = spark.createDataFrame(out, SCHEMA).repartition(4)
    got = jaccard.jaccard_components(d).select("row.doc_id", "row.text", "n_shingles", "component_id")
    want = clusters(out)
    assert 2 < len({w[3] for w in want}) < 250
    assert multiset(got.collect()) == multiset(want)


def hits(text, windows):
    w = plain(text)
    mask, found = [False] * len(w), set()
    for size in {len(x) for x in windows}:
        for i in range(len(w) - size + 1):
            ids = windows.get(tuple(w[i : i + size]))
            if ids:
                found |= ids
                mask[i : i + size] = [True] * size
    return len(w), sum(mask), sorted(found)


@pytest.mark.parametrize("slice_windows", [1 << 20, 20])
def test_decontamination(spark, docs, none, rows, monkeypatch, slice_windows):
    monkeypatch.setattr(decontamination, "SLICE_WINDOWS", slice_windows)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 25 if slice_windows == 20 else 4096)
    t = texts()
    bench = [(1, t[9]), (2, " ".join(t[14].split()[:9]) + " zz"), (3, "two"), (10, t[14]), (None, "a b c d"), (5, None), (6, "..."), (1, "One, TWO"), (7, t[31])]
    table = spark.createDataFrame(bench, "item_id int, text string")
    windows = defaultdict(set)
    for i, x in bench:
        w = plain(x)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add("null" if i is None else str(i))
    got = decontamination.decontaminate(docs, table).select("row.doc_id", "row.text", "n_words", "n_hit", F.array_join("items", ","))
    want = [(r[0], r[1], n, h, ",".join(f)) for r in rows for n, h, f in [hits(r[1], windows)]]
    assert multiset(got.collect()) == multiset(want)
    assert sum(x[3] > 0 for x in want) > 8
    assert decontamination.decontaminate(none, table).count() == 0
    assert decontamination.decontaminate(docs, table.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_bpe(docs, none, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], r[1], tuple(ids), t.decode(ids, skip_special_tokens=False)))
    got = bpe.encode(docs, lexicon_words=20).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert multiset((a, b, tuple(c), d) for a, b, c, d in got) == multiset(want)
    assert bpe.encode(none).count() == 0


def test_lexicon():
    words = {w.encode(): (i, i + 1) for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "é"])}
    lexicon = bpe.Lexicon(bpe.Lexicon.compile(words))
    assert [lexicon.ids_of(n) for n in lexicon.numbers(list(words)).tolist()] == list(words.values())
    assert lexicon.numbers([b"", b"ta", b"tapss", b"x"]).tolist() == [-1] * 4
    assert len(lexicon.final) < sum(map(len, words))  # suffixes are shared
    vocabulary = bpe.Vocabulary(bpe.default_path())
    rng = random.Random(2)
    odd = [bytes(rng.choice(b" abcth\xc3\xa9e") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    assert vocabulary.merge_all(odd) == [vocabulary.merge(w) for w in odd]


def test_words_of_ascii_text():
    import public_tokenizers
    import regex

    assert bpe.BYTE_LEVEL == public_tokenizers.PATTERN  # else the shorter pattern is never taken
    find, plain = bpe.finder(bpe.BYTE_LEVEL), regex.compile(bpe.BYTE_LEVEL).findall
    for a in map(chr, range(128)):
        for b in map(chr, range(128)):
            for text in (a + b, f"x{a}{b}x", f" {a}{b} ", f"'{a}{b}'s", f"1 {a}\n{b}"):
                assert find(text) == plain(text)


def test_coder_forgets(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "CACHED_WORDS", 40)
    v = bpe.Vocabulary(bpe.default_path())
    frequent = [b" the", b" and", b"a"]
    coder = bpe.Coder(v, public_tokenizers.PATTERN, bpe.Lexicon.compile({w: v.merge(w) for w in frequent}))
    rng = random.Random(4)
    most = 0
    for _ in range(40):
        texts = [" ".join(rng.choice(["the", "and", "é", "a", str(rng.randint(0, 500)), "zq" * rng.randint(1, 40)]) for _ in range(20)) for _ in range(2)] + [None, "", "<|endoftext|>é the"]
        for text, x in zip(texts, coder.encode(texts)):
            want = [i for special, part in coder.cut(text or "") for w in ([part] if special else coder.words(part)) for i in ((v.special[w],) if special else v.merge(w.encode()))]
            assert (x.ids().tolist(), x.text()) == (want, text or "")
            assert bpe.digest(x) == (len(want), sha(",".join(map(str, want))), sha(text or ""))
        most = max(most, len(coder.known) + len(coder.older))
    assert most <= 40 + 3 * 50  # two halves and the words of the last batches
    coder.forget()
    assert not coder.known and not coder.older


def test_bpe_leaves_no_coder(monkeypatch):
    """Idle Python workers keep neither vocabulary nor words, and only some texts are cut into words at once."""
    import public_tokenizers
    from tokenizers import Tokenizer

    made, sizes = [], []

    class Watched(bpe.Coder):
        def __init__(self, *a):
            super().__init__(*a)
            made.append(weakref.ref(self))

        def encode(self, texts):
            sizes.append(sum(len(t or "") for t in texts))
            return super().encode(texts)

    monkeypatch.setattr(bpe, "Coder", Watched)
    monkeypatch.setattr(bpe, "ENCODED_CHARS", 1000)
    texts = [None, "", "one two " * 40, *("ab cd " * n for n in range(60)), "x" * 3000, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["row", "text"])
    vocabulary = bpe.Vocabulary(bpe.default_path())
    shared = (pickle.dumps(vocabulary), bpe.Lexicon.compile({w: vocabulary.merge(w) for w in (b"ab", b" cd")}))
    out = list(bpe.encode_batches(iter([batch, batch]), shared, public_tokenizers.PATTERN, lambda x: (x.ids(), x.text()), ["ids", "decoded"], [pa.list_(pa.int32()), pa.string()]))
    assert [b.column("decoded").to_pylist() for b in out] == [[t or "" for t in texts]] * 2
    tokenizer = Tokenizer.from_file(bpe.default_path())
    assert out[1].column("ids").to_pylist() == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sum(sizes) == 2 * sum(len(t or "") for t in texts) and max(sizes) < 1000 + 3000
    assert len(made) == 1 and made[0]() is None


def test_token_counts(docs, none, rows):
    import public_tokenizers
    import regex

    vocabulary = set(bpe.Vocabulary(bpe.default_path()).ids)

    def pieces(word):
        b, i, n = word.encode(), 0, 0
        while i < len(b):
            j = len(b)
            while b[i:j] not in vocabulary:
                j -= 1
            i, n = j, n + 1
        return n

    want = []
    for r in rows:
        words = regex.findall(public_tokenizers.PATTERN, r[1] or "")
        want.append((r[0], r[1], len(words), sum(map(pieces, words))))
    got = wordpiece.token_counts(docs).select("row.doc_id", "row.text", "n_words", "n_pieces")
    assert multiset(got.collect()) == multiset(want)
    assert wordpiece.token_counts(none).count() == 0
    small = wordpiece.Automaton([b"ab", b"abcd", b"c", b"d", b"a"])
    assert small.counts([b"abcd", b"abcc", b"abca", b"", b"abx", b"aab"]).tolist() == [1, 3, 3, 0, 1, 2]


def base_counts(text):
    x, w = text or "", spaced(text)
    three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    mask = [False] * len(w)
    for i in range(len(w) - 2):
        if three[tuple(w[i : i + 3])] > 1:
            mask[i : i + 3] = [True] * 3
    lines = [line for line in x.split("\n") if spaced(line)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), sum(mask), n < 50 or 100 * sum(mask) > 50 * n


def test_quality(docs, none, rows):
    got = quality.quality_rules(docs).select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert multiset(tuple(r)[:-1] for r in got) == multiset((r[0], r[1], *base_counts(r[1])) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality.quality_rules(none).count() == 0


def reference_em(patterns, n_rules):
    prior, rules = quality.PRIOR, [dict(quality.START) for _ in range(n_rules)]
    for _ in range(quality.ROUNDS):
        post = []
        for votes, n in patterns:
            good, bad = prior, 1 - prior
            for v, e in zip(votes, rules):
                good *= e["gg"] if v == 1 else e["gb"] if v == 0 else 1 - e["gg"] - e["gb"]
                bad *= e["bg"] if v == 1 else e["bb"] if v == 0 else 1 - e["bg"] - e["bb"]
            post.append((votes, n * good / (good + bad), n * bad / (good + bad)))
        g, b = sum(p[1] for p in post), sum(p[2] for p in post)
        share = lambda j, v, k: (sum(p[k] for p in post if p[0][j] == v) + quality.SMOOTH) / ((g, b)[k - 1] + 3 * quality.SMOOTH)
        rules = [{"gg": share(j, 1, 1), "gb": share(j, 0, 1), "bg": share(j, 1, 2), "bb": share(j, 0, 2)} for j in range(n_rules)]
        prior = min(0.99, max(0.5, (g + quality.PRIOR) / (g + b + 1)))
    return prior, rules


def test_vote_model(spark):
    rng = random.Random(3)
    votes = []
    for _ in range(400):
        good = rng.random() < 0.8
        votes.append(tuple(None if rng.random() < 0.2 else int((rng.random() < 0.9) == good) for _ in range(4)))
    names = [f"v{i}" for i in range(4)]
    got = quality.estimates(spark.createDataFrame(votes, ", ".join(f"{n} int" for n in names)), names).first()
    prior, rules = reference_em(list(Counter(votes).items()), 4)
    assert got["prior"] == pytest.approx(prior, abs=1e-9)
    for a, b in zip(got["rules"], rules):
        assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in b)


def test_quality_on_labels(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_quality_rules"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in got if r["quality"] == 1], [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_language(spark, docs, none):
    got = queries.QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert sum(held) >= 0.98 * len(held)
    filters = language.train(docs)
    seen = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, filters).select("row.doc_id", "lang_pred").collect()}
    assert seen[0] == seen[1] == seen[2] == "und" and seen[20] == "en"
    assert language.identify(none, filters).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.train(none)).collect()} == {"und"}


def test_bit_slices():
    rng = np.random.default_rng(0)
    members = [rng.integers(0, 1 << 32, 5000).astype(np.uint32) for _ in range(3)]
    f = language.Filters(["a", "b", "c"], members)
    for i, g in enumerate(members):
        assert np.all((f.masks(g) >> i) & 1)  # no false negatives
    other = rng.integers(0, 1 << 32, 200_000).astype(np.uint32)
    counts = f.counts(other, np.array([0, len(other)]))
    assert np.all(counts < 0.003 * len(other))  # corrected for false positives


def test_jaccard_sets_are_sent_in_waves(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "WAVE_ROWS", 10, raising=False)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    data = []
    for i in range(14):
        w = list(base)
        for k in rng.sample(range(60), i % 4):
            w[k] = f"x{i}"
        data.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in data}
    h, counts = jaccard.shingle_sets(pa.array([t for _, t in data]), 5)
    nodes = jaccard.digests(h, counts)[0].tolist()
    at = {n: i for i, n in enumerate(nodes)}
    pairs = sorted({(min(x, y), max(x, y)) for x in nodes for y in nodes if x != y})
    assert len(pairs) > 40
    released = []
    monkeypatch.setattr(jaccard, "release", lambda s: released.append(1))
    held = jaccard.Sets(spark.createDataFrame(data, "doc_id long, text string").select("text"), 5, np.zeros(0, np.int64))
    got = sorted((r["u"], r["v"]) for r in held.linked(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    want = [(a, b) for a, b in pairs if 100 * len(sets[at[a]] & sets[at[b]]) >= 80 * len(sets[at[a]] | sets[at[b]])]
    assert got == want and want and len(released) >= len(pairs) // 10


def test_jaccard_cuts_only_texts_of_candidates(spark, monkeypatch):
    words = [" ".join(f"a{k}b{i}" for i in range(30)) for k in range(50)]
    h, counts = jaccard.shingle_sets(pa.array(words), 5)
    nodes = jaccard.digests(h, counts)[0]
    wanted, ths = (jaccard.Bitmap(np.zeros(1 << 13, np.uint8)) for _ in range(2))
    wanted.add(nodes[:3].view(np.uint64))
    ths.add(np.arange(100, 103).astype(np.uint64))
    b = pa.RecordBatch.from_arrays([pa.array(range(100, 150), pa.int64()), pa.array(words)], ["th", "text"])
    cut, plain = [], jaccard.shingle_sets
    monkeypatch.setattr(jaccard, "shingle_sets", lambda text, n: cut.append(len(text)) or plain(text, n))
    got = [r for x in jaccard.set_rows(5, wanted, np.zeros(0, np.int64), ths)(iter([b, b])) for r in x.to_pylist()]
    assert sorted(r["node"] for r in got) == sorted(nodes[:3].tolist()) and sum(cut) == 6
    monkeypatch.undo()
    d = spark.createDataFrame([(100 + i, t) for i, t in enumerate(words)], "th long, text string")
    signed = spark.createDataFrame([(int(n), th) for i, n in enumerate(nodes) for th in (100 + i, 900 + i)], "node long, th long")
    held = jaccard.Sets(d, 5, np.zeros(0, np.int64), 0, signed)
    for x, y in ((0, 1), (1, 7)):
        held.add(spark.createDataFrame([(int(nodes[x]), int(nodes[y]))], "a bigint, b bigint"))
    assert sorted(r["node"] for r in held.rows.collect()) == sorted(nodes[[0, 1, 7]].tolist())


@pytest.mark.parametrize("few", [1 << 20, 40, 0])
def test_components_take_few_jobs(spark, monkeypatch, few):
    """What one batch can hold is joined in it, not in rounds of joins of a dozen small jobs each."""
    monkeypatch.setattr(jaccard, "FEW_LINKS", few, raising=False)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(-5, 7), (7, 7), (9, -(1 << 62))]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if find(x) != x}
    d = spark.createDataFrame(links, "u long, v long").repartition(3)
    sc = spark.sparkContext
    sc.setJobGroup(f"components {few}", "")
    try:
        got = {r["node"]: r["comp"] for r in jaccard.components(d).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == want
    if few > len(links):
        assert len(sc.statusTracker().getJobIdsForGroup(f"components {few}")) <= 8
    monkeypatch.setattr(jaccard, "FEW_LINKS", few, raising=False)
    labels = jaccard.joined(None, d.where("u < 250"))
    got = {r["node"]: r["comp"] for r in jaccard.joined(labels, d.where("u >= 250")).collect() if r["node"] != r["comp"]}
    assert got == want


def test_toxicity(spark, none):
    d = "/root/testdata/sf0.1"
    got = queries.QUERIES["op4_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = [r["predicted"] for r in got if r["toxic"] == 1]
    false = [r["predicted"] for r in got if r["toxic"] == 0]
    assert sum(hit) >= 0.75 * len(hit) and sum(false) <= 0.04 * len(false)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(none, None).count() == 0
    assert toxicity.train(spark.createDataFrame([("x", 1, "en")], "text string, toxic int, lang string")) is None


def test_long_text_scores_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(1, toxicity.BUCKETS, (2, 3000)).astype(np.int32)
    m = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)), [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS], np.zeros(18), rng.normal(size=19))
    at = np.array([0, 2990, 3000])
    whole = toxicity.logits(m, m.tables(), ids, at)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.allclose(whole, toxicity.logits(m, m.tables(), ids, at))


def test_toxicity_by_loops():
    rng = np.random.default_rng(3)
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    m = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)), [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS], rng.normal(size=n), rng.normal(size=n + 1))
    words = ["alpha", "beta", "alphas", "gamma", "Beta"]
    data = [" ".join(rng.choice(words, k)) for k in (1, 2, 3, 9)] + ["", None, "alpha beta", "alpha beta"]
    ids, at = toxicity.bucket_ids(*kernels.text_buffer(pa.array(data, pa.string())))
    got = toxicity.logits(m, m.tables(), ids, at)
    for k in range(len(data)):
        x = ids[:, at[k] : at[k + 1]]
        assert x.shape[1] == len((data[k] or "").split()) + 3 and not x[:, -3:].any()
        pooled = []
        for w, conv in zip(toxicity.WIDTHS, m.conv):
            for f in range(toxicity.FILTERS):
                pooled.append(max(sum(float(m.embed[x[r, i + j]] @ conv[j][:, f]) for j in range(w) for r in range(2)) for i in range(x.shape[1] - w + 1)))
        want = sum(max(p + b, 0.0) * o for p, b, o in zip(pooled, m.bias, m.out[:-1])) + m.out[-1]
        assert got[k] == pytest.approx(want)
    assert got[6] == got[7] and got[4] == got[5]
    # the gradient against finite differences
    y, weight = np.array([1, 0, 1, 0, 0, 1, 1, 0.0]), np.linspace(1, 2, 8)
    m.out *= 0.05

    def loss():
        p = toxicity.sigmoid(toxicity.logits(m, m.tables(), ids, at))
        return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(y))

    for part, g in zip([m.embed, *m.conv, m.bias, m.out], toxicity.gradients(m, ids, at, y, weight)):
        flat, slope = part.reshape(-1), g.reshape(-1)
        for i in [*np.argsort(-np.abs(slope))[:5].tolist(), *rng.integers(0, len(flat), 2).tolist()]:
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert slope[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_toxicity_learns_from_every_row(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 3_000, raising=False)
    # "vile" occurs only in texts that the sample of 8,000 rows, by hash, passed over
    rows = spark.range(8_000).selectExpr("concat('plain words ', id % 97, ' of row ', id) AS text", "0 AS toxic")
    bad = spark.range(500).selectExpr("concat('rotten words ', id % 97, ' of row ', id) AS text", "1 AS toxic")
    rare = spark.range(20_000).selectExpr("concat('vile words ', id % 97, ' of row ', id) AS text", "1 AS toxic")
    rare = rare.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) >= int(8_000 / 9_000 * (1 << 20))).limit(500)
    d = rows.unionAll(bad).unionAll(rare).withColumn("lang", F.lit("en"))
    model = toxicity.train(d)
    new = spark.createDataFrame([(w, f"{w} words {i} of row new{i}") for w in ("plain", "rotten", "vile") for i in range(20)], "kind string, text string")
    got = defaultdict(list)
    for r in toxicity.score(new, model).select("row.kind", "score").collect():
        got[r["kind"]].append(r["score"] >= 0.3)
    assert not any(got["plain"]) and all(got["rotten"]) and all(got["vile"])


def test_toxicity_cuts_by_loops(spark):
    rng = random.Random(4)
    data = [(rng.choice(["en", "de", "", None]), int(rng.random() < 0.3), rng.choice([-2.0, -0.5, 0.25, 1.0, 3.0]) + rng.randrange(12)) for _ in range(400)] + [("xx", 1, 7.0), ("yy", 0, 2.0), ("yy", 1, 3.0)]
    d = spark.createDataFrame(data, "lang string, y int, z double")
    for parts in (1, 5):
        got = toxicity.best_cuts(d, parts)
        assert set(got) == {"", "en", "de", "xx", "yy"}
        for g, (at, ones, n) in got.items():
            own = [(z, y) for x, y, z in data if g in ("", x)]
            f1 = lambda c: 2 * sum(y for z, y in own if z >= c) / (sum(z >= c for z, _ in own) + sum(y for _, y in own))  # noqa: B023, E731
            top = max({z for z, _ in own}, key=lambda c: (f1(c), c))
            below = max((z for z, _ in own if z < top), default=top - 1)
            assert (at, ones, n) == ((top + below) / 2, sum(y for _, y in own), len(own))


def test_toxicity_edges(spark):
    data = [(1, "bad words here", 1, "en"), (2, "nice words here", 0, "en"), (2, "nice words here", 0, "en"), (3, None, 1, "en"), (4, "", 0, None), (None, "... !!", 0, "en"), (5, "long " * 200_000, 0, "en")] * 12
    d = spark.createDataFrame(data, "doc_id long, text string, toxic int, lang string").withColumns({"row": F.lit("r"), "score": F.lit(9), "a.b c": F.lit(1)})
    model = toxicity.train(d)
    got = toxicity.score(d, model).select("row.doc_id", "row.text", "score", F.col("row.`a.b c`").alias("x")).collect()
    assert len(got) == len(data) and all(r["x"] == 1 for r in got)
    by = defaultdict(set)
    for r in got:
        by[r["text"]].add(r["score"])
        assert 0 <= r["score"] <= 1
    assert all(len(x) == 1 for x in by.values())
    assert by[None] == by[""] == by["... !!"] == {0.0}


def test_language_by_loops(spark):
    rng = random.Random(11)
    words = {x: ["".join(rng.choice(letters) for _ in range(6)) for _ in range(30)] for x, letters in (("aa", "abcdefg"), ("bb", "fghijklm"), ("cc", "mnopqrsé"))}
    data = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(1, 40))), x) for i, x in enumerate(list(words) * 20)]
    data += [data[0], data[0], (None, data[1][1] + " " + data[2][1], "aa"), (900, "ABCDEFG abcdefg", None), (901, "zzzz wwww", "aa"), (902, "12 34", "bb"), (903, None, "cc"), (904, "Ünïcode", "cc")]
    data += [(905, " ".join(rng.choice(words["bb"]) for _ in range(120_000)), "bb")]  # beyond the pieces worked on at once
    d = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    f = language.train(d)
    mask = (1 << 32) - 1

    def place(g, k):
        x = (g * language.ODD[k] & mask) ^ (g >> (15 + k))
        return (x * language.ODD[k + 2] & mask) >> (32 - language.CELL_BITS)

    bits = [[int(c) >> i & 1 for c in f.cells] for i in range(len(f.languages))]
    shares = [(sum(b) / len(b)) ** language.HASHES for b in bits]

    def judge(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        b = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode())
        grams = [int.from_bytes(b[i : i + 4], "big") for i in range(len(b) - 3) if 32 not in (b[i + 1], b[i + 2])]
        counts = {}
        for i, name in enumerate(f.languages):
            hits = sum(all(bits[i][place(g, k)] for k in range(language.HASHES)) for g in grams)
            counts[name] = max(0.0, (hits - shares[i] * len(grams)) / (1 - shares[i]))
        total = sum(counts.values())
        if not total:
            return f.languages[0], 1 / len(f.languages)
        best = min(counts, key=lambda x: (-counts[x], x))
        return best, counts[best] / total

    got = language.identify(d, f).select("row.text", "lang_pred", "score", "row.lang_pred").collect()
    assert len(got) == len(data)
    for text, pred, score, other in got:
        want = judge(text)
        assert pred == want[0] and score == pytest.approx(want[1]) and other == "clash"


def test_revisits(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = queries.QUERIES["op5_warc_revisits"](spark, SF)
    assert multiset(got.collect()) == multiset(con.sql(revisits.OP5_SQL).fetchall())
    schema = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>, u string"
    data = [(i, "http://H.example:80/a/?b=2&a=1&utm_x=3#f", i * 2, "response", 200, f'"{i}"', None, None, {"etag": f'"{i}"', "x": "1"}, "c") for i in range(200)]
    data += [(1000 + i, "https://www.h.example/a?a=1&b=2", i * 2 + 1, "revisit", 304, f'W/"{i}"', None, None, {"date": "d", "x": "2"}, "c") for i in range(200)]
    data += [(2000, None, 5, "revisit", 304, None, None, None, None, None), (2001, "odd", None, "revisit", 304, None, None, None, None, None), (2002, "https://h.example/a?b=2&a=1", 3, "revisit", 304, None, None, None, None, None), (2003, "https://h.example/a?b=2&a=1", 3, "revisit", 304, '"9"', None, None, None, None)]
    out = {r["record_id"]: r for r in revisits.resolve(spark.createDataFrame(data, schema), periods=7).collect()}
    assert len(out) == 204
    for i in range(200):
        r = out[1000 + i]
        assert (r["original_id"], r["outcome"], r["headers"]) == (i, "resolved", {"etag": f'"{i}"', "x": "1", "date": "d"}), r
    assert [out[k]["outcome"] for k in (2000, 2001, 2002, 2003)] == ["no_original", "no_original", "unvalidated", "mismatch"]
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


def test_revisits_ties_and_repeats(spark):
    schema = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>, u string"
    u = "http://a.example/p"
    data = [(1, u, 5, "response", 200, None, "mon", "d1", {"last-modified": "mon", "vary": "x"}, "c"), (2, u, 5, "response", 200, None, "tue", "d1", {"last-modified": "tue"}, "c")]
    data += [(3, u, 5, "revisit", 304, None, "tue", "dx", {"vary": "y", "server": "s"}, "c")] * 2  # same time, repeated; last-modified goes before the digest
    data += [(4, u, 9, "revisit", 304, None, "mon", "d1", None, "c"), (0, u, 5, "revisit", 304, None, "mon", None, None, "c"), (5, u, None, "revisit", 304, None, "mon", None, None, "c")]
    for periods in (1, 3, None):
        got = sorted(tuple(r) for r in revisits.resolve(spark.createDataFrame(data, schema), periods).select("record_id", "original_id", "outcome", F.element_at("headers", "vary")).collect())
        assert got == [(0, None, "no_original", None), (3, 2, "resolved", "y"), (3, 2, "resolved", "y"), (4, None, "mismatch", None), (5, None, "no_original", None)]
    edges = sorted(random.Random(1).sample(range(1000), 50))
    rows_ = spark.range(1000).select(revisits.period_of(F.col("id"), edges).alias("p")).collect()
    assert [r["p"] for r in rows_] == [sum(e <= i for e in edges) for i in range(1000)]


def test_warc_files(spark, tmp_path):
    import gzip

    def record(kind, rid, url, date, head, body=b""):
        block = head.encode() + b"\r\n\r\n" + body
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    parts = [
        record("warcinfo", "i", "", "2020-01-01T00:00:00Z", "software: x"),
        record("response", "r1", "http://a.example/p", "2020-01-01T00:00:00Z", 'HTTP/1.1 200 OK\r\nETag: "1"\r\nVary: a', b"<html>WARC/1.0 is no record here</html>" * 50),
        record("revisit", "v1", "https://www.a.example/p/", "2020-01-02T00:00:00Z", 'HTTP/1.1 304 Not Modified\r\nETag: W/"1"\r\nVary: b'),
        record("revisit", "v2", "http://b.example/", "2020-01-02T00:00:00Z", "HTTP/1.1 304 Not Modified"),
    ]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts[:2]))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(map(gzip.compress, parts[2:])) + b"\x1f\x8bbroken")
    (tmp_path / "empty.warc").write_bytes(b"")
    records = revisits.read_warc(spark, str(tmp_path))
    assert sorted(r["record_id"] for r in records.collect()) == ["r1", "v1", "v2"]
    got = {r["record_id"]: (r["original_id"], r["outcome"], r["headers"]) for r in revisits.resolve(records).collect()}
    assert got == {"v1": ("r1", "resolved", {"etag": 'W/"1"', "vary": "b"}), "v2": (None, "no_original", None)}


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = [(r["doc_id"], r["text"]) for r in quality.quality_rules(docs).where("kept").select("row.*").collect()]
    groups = clusters([(i, x) for i, x in kept])
    kept = sorted((i, x) for (i, x), g in zip(kept, groups) if g[3] == i)
    first = {}
    for i, x in kept:
        w = spaced(x)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    cleaned = []
    for i, x in kept:
        w = spaced(x)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        cleaned.append((i, " ".join(a for a, g in zip(w, gone) if not g) if any(gone) else x))
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{d}/benchmark.parquet").collect():
        w = plain(r["text"])
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add(r["item_id"])
    want = sorted((i, sha(x)) for i, x in cleaned if not hits(x, windows)[1])
    got = corpus_pipeline.run(spark, d)
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in got.collect()) == want
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), d).count() == 0, name


def test_pipeline_keeps_unlinked_texts(spark, docs, rows):
    import corpus_pipeline

    more = [(None, f"{w} {w}a {w}b {w}c {w}d {w}e", *[None] * 8) for w in ("north", "south", "east")]  # no id
    more += [(5000, x, *[None] * 8) for x in ("red green blue white black grey", "one two three four five six")]  # one id
    data = rows + more
    members = defaultdict(list)
    for r, g in zip(data, clusters([(i, r[1]) for i, r in enumerate(data)])):  # components of texts, whatever the ids
        members[g[3]].append((r[0], r[1], g[2]))
    got = Counter(tuple(r) for r in corpus_pipeline.ngram_jaccard(spark, docs.unionByName(spark.createDataFrame(more, SCHEMA)), SF).select("doc_id", "text").collect())
    for rs in members.values():
        kept = [i for i, x in got.elements() if (i, x) in {r[:2] for r in rs}]
        assert kept == [min((r[0] for r in rs), key=lambda i: (i is None, i))]
    assert sum(got.values()) == len(members)
    assert all(got[r[:2]] == 1 for r in more)


def test_pipeline_runs_all_levels(docs, monkeypatch):
    import corpus_pipeline

    lengths, one = [], substring_dedup.next_level
    monkeypatch.setattr(substring_dedup, "next_level", lambda state, length, *a: lengths.append(length) or one(state, length, *a))
    assert corpus_pipeline.substring(docs.sparkSession, docs, SF).count() == docs.count()
    assert lengths[:3] == [13, 26, 52]


def test_more_than_64_languages(spark):
    rng = random.Random(3)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(12)] for _ in range(70)]
    data = [(i, " ".join(rng.choice(w) for _ in range(40)), f"l{i:02}") for i, w in enumerate(words)]
    d = spark.createDataFrame(data * 4, "doc_id long, text string, lang string")
    filters = language.train(d)
    assert len(filters.languages) == 70
    got = language.identify(d, filters).select("row.lang", "lang_pred").collect()
    assert all(r["lang"] == r["lang_pred"] for r in got)


def test_ids_and_columns_of_any_kind(spark, rows):
    """String ids, names with dots, spaces and backticks, names that the operators use."""
    ids = lambda i: None if i is None else f"k{i:05}"
    odd = ["row", "id", "th", "q", "node", "n_words", "kept", "a.b", "my col", "tick`s"]
    data = [(ids(r[0]), r[1], "en", *range(len(odd))) for r in rows]
    kind = StructType([StructField("key.of", StringType()), StructField("the text", StringType()), StructField("lang", StringType()), *(StructField(c, LongType()) for c in odd)])
    d = spark.createDataFrame(data, kind).repartition(3)
    carried = F.struct(*[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(odd)]).alias("carried")
    name = {"id_col": "key.of", "text_col": "the text"}
    plain_ids = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")

    def both(got, want, columns, ids_=()):
        a = got.select(F.col("row")["key.of"].alias("k"), carried, *columns).collect()
        assert all(tuple(r["carried"]) == tuple(range(len(odd))) for r in a)
        b = want.select(F.col("row")["doc_id"].alias("k"), *columns).collect()
        fix = lambda r: (ids(r["k"]), *(ids(r[c]) if c in ids_ else r[c] for c in columns))
        assert multiset([(r["k"], *(r[c] for c in columns)) for r in a]) == multiset(map(fix, b))

    both(substring_dedup.substring_dedup(d, **name), substring_dedup.substring_dedup(plain_ids), ["n_words", "n_removed", "kept", "longest_repeat"])
    both(suffix_dedup.suffix_dedup(d, **name), suffix_dedup.suffix_dedup(plain_ids), ["n_bytes", "n_removed", "n_spans", "kept"])
    both(jaccard.jaccard_components(d, **name), jaccard.jaccard_components(plain_ids), ["n_shingles", "component_id"], ["component_id"])
    bench = spark.createDataFrame([("i.1", rows[9][1]), (None, "a b c d")], StructType([StructField("item.id", StringType()), StructField("its text", StringType())]))
    one = decontamination.decontaminate(d, bench, **name, item_col="item.id", item_text_col="its text")
    two = decontamination.decontaminate(plain_ids, bench.toDF("item_id", "text"))
    both(one, two, ["n_words", "n_hit"])
    both(wordpiece.token_counts(d, text_col="the text"), wordpiece.token_counts(plain_ids), ["n_words", "n_pieces"])
    both(quality.quality_rules(d, text_col="the text"), quality.quality_rules(plain_ids), ["n_words", "kept"])
    filters = language.train(d, text_col="the text")
    both(language.identify(d, filters, text_col="the text"), language.identify(plain_ids, filters), ["lang_pred"])
    both(bpe.encode(d, text_col="the text"), bpe.encode(plain_ids), ["decoded"])
    both(toxicity.score(d, None, text_col="the text"), toxicity.score(plain_ids, None), ["score"])


def test_very_long_texts(spark):
    """Beyond the borders at which the operators cut what they work on."""
    rng = random.Random(17)
    make = lambda n: " ".join(rng.choice(WORDS_300) for _ in range(n))
    big = make(115_000)  # over half a MB
    w = big.split(" ")
    near = " ".join(w[:60_000] + ["Changed"] + w[60_000:])
    data = [(1, big), (2, near), (3, " ".join(w[110_000:110_400])), (4, make(300)), (5, "zz " * 40_000 + " ".join(w[5:60]))]
    assert len(big) > 1 << 19
    d = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(d).select("row.doc_id", "component_id").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    first = {}
    for i, x in data:
        v = spaced(x)
        for k in range(len(v) - 12):
            first.setdefault(tuple(v[k : k + 13]), i)
    want = {}
    for i, x in data:
        v = spaced(x)
        hit = np.array([k for k in range(len(v) - 12) if first[tuple(v[k : k + 13])] < i], int)
        want[i] = int(kernels.covered(hit, 13, len(v)).sum()) if len(hit) else 0
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(d).select("row.doc_id", "n_removed").collect()} == want
    windows = defaultdict(set)
    item = " ".join(w[80_000:80_030])
    for k in range(21):
        windows[tuple(plain(item)[k : k + 10])].add("7")
    bench = spark.createDataFrame([(7, item)], "item_id int, text string")
    hit = {r["doc_id"]: r["n_hit"] for r in decontamination.decontaminate(d, bench).select("row.doc_id", "n_hit").collect()}
    assert hit == {i: hits(x, windows)[1] for i, x in data}
    seen = Counter(hash(b[k : k + 200]) for _, x in data for b in [x.encode()] for k in range(len(b) - 199))
    removed = {}
    for i, x in data:
        b = x.encode()
        at = np.array([k for k in range(len(b) - 199) if seen[hash(b[k : k + 200])] > 1], int)
        removed[i] = int(kernels.covered(at, 200, len(b)).sum()) if len(at) else 0
    for options in ({}, {"limit": 1 << 16}, {"hot_contents": 3}):  # mapped files; hot anchors
        got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(d, **options).select("row.doc_id", "n_removed").collect()}
        assert got == removed, options


def test_parameters_are_checked(spark, none):
    for length in (15, 255, 300):
        with pytest.raises(ValueError, match="length must be"):
            suffix_dedup.suffix_dedup(none, length=length)
    with pytest.raises(ValueError, match="window must be"):
        substring_dedup.substring_dedup(none, window=1)
    import public_tokenizers

    with pytest.raises(ValueError, match="no plain byte-level BPE"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
