"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The vocabulary and merges come from a tokenizer file; nothing is trained. Pre-tokens
("words") are counted over all documents; the LEXICON_WORDS most frequent ones are merged
once and compiled into an acyclic automaton whose equal suffixes share states (built from
the sorted words, registering each finished state). Every edge carries the number of words
that sort before it, so the sum along a path is the word's number, and that number points
to its ids: the automaton is a transducer from words to id sequences. Its arrays are one
flat file, which Python workers memory-map. All distinct words of a batch walk through it
together, byte by byte; words that it lacks are merged exactly by merge rank.

Defined results. A null text is empty; an empty text has no ids. Special tokens of the file
are matched in the text before anything else, longest first. Every byte has an id, so any
text can be encoded; decoding replaces invalid UTF-8 as the library does. Repeated rows get
equal results. Carried columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

import gc
import hashlib
import json
import math
import mmap
import pickle
import re
import tempfile
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, column, cut, fields, map_batches, prepare, table
from .substring_dedup import spans

LEXICON_WORDS = 30_000
COUNTED_WORDS = 200_000  # distinct words that a task counts before it hands them on
CACHED_WORDS = 200_000
ENCODED_CHARS = 1 << 22  # of texts whose words a worker holds at once: about a usual batch, as short lists take more CPU
NO_PAIR = 1 << 62
NUMBERS = list(map(str, range(1 << 17)))
I8 = np.int64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class Vocabulary:
    """What a tokenizer file holds: ids and bytes of tokens, merge ranks and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, before = data["model"], data.get("pre_tokenizer") or {}
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or odd or data.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level BPE file: its normalizer, pre-tokenizer or model options ({', '.join(odd) or 'see the file'}) would be ignored")
        to_byte = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        plain = lambda token: b"".join(to_byte[c] for c in token)
        vocab = data["model"]["vocab"]
        self.ids = {plain(t): i for t, i in vocab.items()}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[plain(a), plain(b)] = rank
        pairs = {(self.ids[a] << 16) | self.ids[b]: (r, self.ids[a + b]) for (a, b), r in self.ranks.items()} if max(vocab.values(), default=0) < 1 << 16 else {}
        self.pair_key = np.array(sorted(pairs), np.uint32)
        self.pair_value = np.array([(pairs[k][0] << 16) | pairs[k][1] for k in sorted(pairs)], np.int64)  # rank, then id
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """The ids of one pre-token: the lowest-ranked adjacent pair, leftmost first, is joined
        until none is left. Linked neighbours and a heap keep long words near linear."""
        from heapq import heapify, heappop, heappush

        n = len(word)
        parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((parts[i], parts[k]))) is not None:
                    heappush(heap, (r, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heappush(heap, (r, h, parts[h], parts[i]))
        return tuple(self.ids[p] for p in parts if p is not None)


    def pair_values(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and id of what each pair of ids is joined to; NO_PAIR if it isn't, or b is none (-1)."""
        key = (a.astype(np.uint32) << np.uint32(16)) | (b.astype(np.uint32) & np.uint32(0xFFFF))
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (b >= 0), self.pair_value[at], NO_PAIR)

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """merge() of many words at once."""
        flat, counts = self.merged(words)
        ids, ends = flat.tolist(), np.cumsum(counts).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words and how many each has. In each round every word joins its
        lowest-ranked, leftmost pair, and only the pairs on both sides of it are looked up again."""
        sizes = np.fromiter(map(len, words), I8, len(words))
        short = (sizes > 0) & (sizes <= 48) & (len(self.pair_key) > 0)
        plain = np.flatnonzero(~short)
        whole = [self.merge(words[i]) for i in plain.tolist()]
        flat, which, counts = [np.fromiter(chain.from_iterable(whole), np.int32)], [plain], [np.fromiter(map(len, whole), I8, len(whole))]
        single = np.array([self.ids.get(bytes([b]), 0) for b in range(256)], np.int32)
        order = np.flatnonzero(short)
        order = order[np.argsort(sizes[order], kind="stable")]
        for k in range(0, len(order), 8192):
            part = order[k : k + 8192]
            tok = np.full((len(part), int(sizes[part[-1]]) + 1), -1, np.int32)
            tok[np.arange(tok.shape[1]) < sizes[part][:, None]] = single[np.frombuffer(b"".join([words[i] for i in part.tolist()]), np.uint8)]
            value = self.pair_values(tok[:, :-1], tok[:, 1:])
            while len(part):
                best = value.argmin(axis=1)
                low = value[np.arange(len(part)), best]
                more = low < NO_PAIR
                if not more.all():
                    done = tok[~more]
                    which.append(part[~more])
                    counts.append((done >= 0).sum(axis=1))
                    flat.append(done[done >= 0])
                    part, tok, value, best, low = (x[more] for x in (part, tok, value, best, low))
                row = np.arange(len(part))
                tok[row, best] = low & 0xFFFF
                tok, value = without(tok, best + 1), without(value, best)
                value[row, best] = self.pair_values(tok[row, best], tok[row, best + 1])
                left = np.flatnonzero(best)
                at = best[left]
                value[left, at - 1] = self.pair_values(tok[left, at - 1], tok[left, at])
        ids, at, n = np.concatenate(flat), np.concatenate(which), np.concatenate(counts)
        back = np.empty(len(at), I8)
        back[at] = np.arange(len(at))
        return ids[spans((np.cumsum(n) - n)[back], n[back])], n[back]


def without(x: np.ndarray, column_: np.ndarray) -> np.ndarray:
    """x without one cell of each row."""
    keep = np.ones(x.shape, bool)
    keep[np.arange(len(x)), column_] = False
    return x[keep].reshape(len(x), x.shape[1] - 1)


class Lexicon:
    """A minimal acyclic automaton of words, whose edges add up to a word's number.

    Arrays: key (state * 256 + byte, ascending), target and skipped words of each edge;
    final states; and, by word number, where its ids start in the flat id array.
    """

    FIELDS = (("key", np.int64), ("target", np.int32), ("skip", np.int32), ("final", np.bool_), ("start", np.int64), ("id", np.int32))

    @classmethod
    def compile(cls, words: dict[bytes, tuple[int, ...]]) -> bytes:
        ordered = sorted(w for w in words if w)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []  # final, edges (byte, target)
        open_: list[list] = [[False, []]]  # the path of the last word: final, finished edges

        def close(depth: int, word: bytes) -> None:
            while len(open_) - 1 > depth:
                final, edges = open_.pop()
                shape = (final, tuple(edges))
                if shape not in register:
                    register[shape] = len(states)
                    states.append(shape)
                open_[-1][1].append((word[len(open_) - 1], register[shape]))

        last = b""
        for w in ordered:
            common = 0
            while common < min(len(w), len(last)) and w[common] == last[common]:
                common += 1
            close(common, last)
            open_ += [[False, []] for _ in w[common:]]
            open_[-1][0] = True
            last = w
        close(0, last)
        states.append((open_[0][0], tuple(open_[0][1])))
        number = [0] * len(states)
        key, target, skip = [], [], []
        order = [len(states) - 1, *range(len(states) - 1)]  # the start state is 0
        place = {s: i for i, s in enumerate(order)}
        for s, (final, edges) in enumerate(states):  # targets come before their sources
            number[s] = final + sum(number[t] for _, t in edges)
        for s in order:
            final, edges = states[s]
            before = int(final)
            for byte, t in edges:
                key.append(place[s] * 256 + byte)
                target.append(place[t])
                skip.append(before)
                before += number[t]
        ids = [words[w] for w in ordered]
        arrays = {"key": key, "target": target, "skip": skip, "final": [states[s][0] for s in order], "start": np.cumsum([0, *map(len, ids)]), "id": list(chain.from_iterable(ids))}
        parts = [np.asarray(arrays[n], k).tobytes() for n, k in cls.FIELDS]
        head = np.array([len(p) for p in parts], np.int64).tobytes()
        return head + b"".join(p + bytes(-len(p) % 8) for p in parts)

    def __init__(self, data: bytes):
        """Maps the compiled arrays from an unnamed file of the worker's own folder."""
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        at = 8 * len(self.FIELDS)
        for (name, kind), n in zip(self.FIELDS, np.frombuffer(self.map, np.int64, len(self.FIELDS)).tolist()):
            setattr(self, name, np.frombuffer(self.map, kind, n // np.dtype(kind).itemsize, at))
            at += n + -n % 8

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 if the automaton lacks it."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not len(self.key) or not n:
            return out
        sizes = np.fromiter(map(len, words), np.int64, n)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        flat = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        first = np.cumsum(sizes) - sizes
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.flatnonzero(sizes > 0)
        j = 0
        while len(live):
            want = state[live] * 256 + flat[first[live] + j]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[at] == want
            live, at = live[ok], at[ok]
            state[live] = self.target[at]
            total[live] += self.skip[at]
            j += 1
            done = sizes[live] == j
            end = live[done]
            end = end[self.final[state[end]]]
            out[order[end]] = total[end]
            live = live[~done]
        return out

    def ids_of(self, number: int) -> tuple[int, ...]:
        return tuple(self.id[self.start[number] : self.start[number + 1]].tolist())

    def all_ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words of these numbers and how many each has."""
        counts = self.start[numbers + 1] - self.start[numbers]
        return self.id[spans(self.start[numbers], counts)], counts


def splitter(pattern: str, special: list[str]) -> Callable[[str], list[tuple[bool, str]]]:
    """Cuts a text into special tokens and the stretches between them."""
    import regex

    if not special:
        return lambda text: [(False, text)]
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
    return lambda text: [(i % 2 == 1, x) for i, x in enumerate(cut.split(text)) if x] if cut.search(text) else [(False, text)]


#: The usual pattern, and what it matches in text of ASCII characters only.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL_ASCII = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


def finder(pattern: str) -> Callable[[str], list[str]]:
    """All words of a text. Text of ASCII characters only takes a pattern without Unicode classes."""
    import regex

    find = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL:
        return find
    plain = re.compile(BYTE_LEVEL_ASCII).findall
    return lambda text: plain(text) if text.isascii() else find(text)


class Coded:
    """A text as the words that the coder knows: ids, the ids' decimals and the decoded bytes of each."""

    __slots__ = ("words",)

    def __init__(self, words: list[tuple[bytes, str, bytes]]):
        self.words = words

    def ids(self) -> np.ndarray:
        return np.frombuffer(b"".join([w[0] for w in self.words]), np.int32)

    def decimals(self) -> str:
        return ",".join([w[1] for w in self.words])

    def text(self) -> str:
        return b"".join([w[2] for w in self.words]).decode("utf-8", "replace")


class Coder:
    """Encodes and decodes in one Python worker; keeps what it knows of words it has met
    lately: of two halves of CACHED_WORDS the older one goes when the newer one is full."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, lexicon: bytes):
        self.v, self.words = vocabulary, finder(pattern)
        self.cut = splitter(pattern, list(vocabulary.special))
        self.lexicon = Lexicon(lexicon)
        self.special = dict(zip(vocabulary.special, self.coded(np.array([*vocabulary.special.values()], np.int32), np.ones(len(vocabulary.special), I8))))
        self.known: dict[str, tuple[bytes, str, bytes]] = {}
        self.older: dict[str, tuple[bytes, str, bytes]] = {}

    def coded(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[bytes, str, bytes]]:
        """Of words with these ids, counts a word: what a Coded text is made of."""
        plain = ids.tolist()
        names = list(map(NUMBERS.__getitem__, plain) if max(plain, default=0) < len(NUMBERS) else map(str, plain))
        tokens = list(map(self.v.tokens.__getitem__, plain))
        raw, named, text = ids.tobytes(), ",".join(names), b"".join(tokens)
        ends = np.cumsum(counts)
        cuts = []
        for sizes in (np.full(len(plain), 4), np.fromiter(map(len, names), I8, len(plain)) + 1, np.fromiter(map(len, tokens), I8, len(plain))):
            cuts.append(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])].tolist())
        for a, b, c, d, e, f in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:], cuts[2], cuts[2][1:]):
            yield raw[a:b], named[c : d - 1], text[e:f]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHED_WORDS // 2:
            self.known, self.older = {}, self.known
        new = words.difference(self.known)
        back = new.intersection(self.older)
        self.known.update(zip(back, map(self.older.__getitem__, back)))
        found = list(new.difference(back))
        plain = [w.encode() for w in found]
        numbers = self.lexicon.numbers(plain)
        known, lacks = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0)
        for at, (ids, counts) in ((known, self.lexicon.all_ids(numbers[known])), (lacks, self.v.merged([plain[i] for i in lacks.tolist()]))):
            self.known.update(zip([found[i] for i in at.tolist()], self.coded(ids, counts)))

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def encode(self, texts: list[str | None]) -> Iterator[Coded]:
        """Each text's words. Those that no earlier batch had are learnt together."""
        parts = [[x if special else self.words(x) for special, x in self.cut(text)] if text else [] for text in texts]
        words: set[str] = set()
        words.update(*(x for p in parts for x in p if isinstance(x, list)))
        self.learn(words)
        get, special = self.known.__getitem__, self.special
        for p in parts:
            yield Coded(list(chain.from_iterable(map(get, x) if isinstance(x, list) else (special[x],) for x in p)))


def stretches(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, in lists of ENCODED_CHARS or a little more."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= ENCODED_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_batches(batches: Iterator[pa.RecordBatch], shared: tuple[bytes, bytes], pattern: str, outputs: Callable[[Coded], tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """row and outputs of each text. shared: pickled vocabulary and lexicon. Spark keeps Python
    workers, more of them than run at once, so nothing of the coder outlives the task."""
    coder = Coder(pickle.loads(shared[0]), pattern, shared[1])
    for b in batches:
        made = [outputs(x) for texts in stretches(b.column("text").to_pylist()) for x in coder.encode(texts)]
        columns = [pa.array(c, t) for c, t in zip(zip(*made) if made else [[]] * len(names), kinds)]
        yield pa.RecordBatch.from_arrays([b.column("row"), *columns], ["row", *names])
        del made, columns
    del coder
    gc.collect()  # free lists of tuples would keep memory of the words they held


def count_words(pattern: str, special: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, cut = finder(pattern), splitter(pattern, special)
        n: Counter = Counter()
        hand = lambda: pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["word", "n"])
        for b in batches:
            for text in b.column("text").to_pylist():
                for is_special, x in cut(text) if text else ():
                    if not is_special:
                        n.update(find(x))
            if len(n) > COUNTED_WORDS:
                yield hand()
                n.clear()
        if n:
            yield hand()

    return run


def build_lexicon(docs: DataFrame, text_col: str, vocabulary: Vocabulary, pattern: str, words: int = LEXICON_WORDS) -> bytes:
    """The compiled automaton of the most frequent words, counted over all documents."""
    counted = map_batches(docs.select(column(text_col).cast("string").alias("text")), count_words(pattern, list(vocabulary.special)), "word string, n bigint")
    counted = cut(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"))
    # The lowest count that at most `words` words reach, from how many words have each count.
    # Counts are bounded by powers of 1.1, so the histogram is short whatever the corpus.
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(1.1)).cast("int")
    total, least = 0, None
    for r in sorted(counted.groupBy(step.alias("s")).agg(F.count("*").alias("w")).collect(), reverse=True):
        total += r["w"]
        if total > words:
            break
        least = r["s"]
    top = counted.where(step >= least) if least is not None else counted.where("false")
    return Lexicon.compile({(b := r["word"].encode()): vocabulary.merge(b) for r in top.collect()})


def bpe(docs: DataFrame, outputs: Callable[[Coded], tuple], schema: str, text_col: str = "text", path: str | None = None, pattern: str | None = None, carry: list[str] | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """row (struct of `carry`, all columns unless given), and for each document the columns
    of `schema` that outputs(coded text) returns; see encode() for the plain form."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = Vocabulary(path or default_path())
    lexicon = build_lexicon(docs, text_col, vocabulary, pattern, lexicon_words)
    shared = spark.sparkContext.broadcast((pickle.dumps(vocabulary), lexicon))  # bounded by the tokenizer file and LEXICON_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encode_batches(batches, shared.value, pattern, outputs, names, kinds)

    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}[x.split()[1]] for x in schema.split(", ")]
    row = carried(docs, carry)
    return map_batches(docs.select(row, column(text_col).cast("string").alias("text")), run, fields(docs.select(row), ["row"], schema))


def encode(docs: DataFrame, **options) -> DataFrame:
    """row, ids and the text decoded from them."""
    return bpe(docs, lambda x: (x.ids(), x.text()), "ids array<int>, decoded string", **options)


def digest(x: Coded) -> tuple[int, str, str]:
    names = x.decimals()
    return names.count(",") + 1 if names else 0, hashlib.sha256(names.encode()).hexdigest(), hashlib.sha256(x.text().encode()).hexdigest()


def op7_bpe_encoding(spark, sf_dir: str) -> DataFrame:
    out = bpe(table(spark, sf_dir, "documents"), digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", carry=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
