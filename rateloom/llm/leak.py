"""Problem 8: evaluation texts that leak into training text.

A BM25 inverted index of the test items is searched with block-max WAND by every training passage.
Terms are shingles of five words. A stretch of n item words with e of them replaced, dropped or added
keeps at least n - e words in at most e + 1 runs, hence n - 5e - 4 shingles; over all lengths that count
and at most one edit in eight words these are never fewer than five. The least score that so many
shingles of an item can give is the item's own threshold, and impacts are kept relative to it: an item
is retrieved where its relative impacts add up to 1, and none that leaks is lost. What is retrieved is
verified by an exact alignment.

The items are the query set that is stated once for all documents. Their index consists of parts of at most
PART_BYTES, packed arrays in one file each, which is sent to the executors once and mapped into memory there, so
the workers of a machine share it and hold no copy. All parts are searched in one scan of the corpus.
Documents are never shuffled: only found pairs are.

Defined results: null or empty documents hold nothing; an item of fewer than 20 words, null or not,
leaks nowhere; equal items are all reported; repeated document rows give their pair once.
"""

from __future__ import annotations

import atexit
import bisect
import functools
import json
import mmap
import os
import re
import shutil
import tempfile
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a shingle, least words of a passage, and of how many words one may differ.
SHINGLE, LEAST, ONE_IN = 5, 20, 8
#: A passage of twice LEAST words splits into two of which one is within the bound, so longer ones need no look.
LONGEST = 2 * LEAST - 1
#: Shingles that any such passage shares with its item.
SHARED = min(n - SHINGLE * (n // ONE_IN) - (SHINGLE - 1) for n in range(LEAST, LONGEST + 1))
#: Words of a query passage and their step: any aligned stretch lies within one.
PASSAGE, STEP = 96, 48
#: BM25 parameters and postings of a block.
K1, B, POSTINGS = 1.2, 0.75, 64
#: Bytes of a part of the index, and what an item's word takes of them at most: key, range, posting, block, id.
PART_BYTES, WORD_BYTES = 64 << 20, 64
#: Words whose number a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: A sum of relative impacts from which an item is retrieved; single precision leaves room.
NEED = 1.0 - 1e-4
_WORD = re.compile(r"[^\W_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63))


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case; a line break written as a backslash and n separates words."""
    return _WORD.findall(text.replace("\\n", " ").lower())


def shingle_keys(ids: np.ndarray) -> np.ndarray:
    """A 64-bit key for each run of five word ids (uint64)."""
    n = len(ids) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        key = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            x = ids[k : k + n] * _MIX[k]
            key += x ^ (x >> np.uint64(29))
            key *= _MIX[0]
    return key


def word_key(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) or 1


def pack(items: list[tuple[object, list[str]]]) -> dict[str, np.ndarray]:
    """The arrays of a part: items of at least LEAST words as (position in the part's list of ids, words).

    terms are sorted; from start[t] to start[t + 1] lie the postings of term t, their items and relative impacts;
    block_start likewise gives its blocks, with the last item and the greatest impact of each.
    """
    texts = [np.array([word_key(x) for x in w], np.uint64) for _, w in items]
    keys = [shingle_keys(t) for t in texts]
    df: Counter = Counter()
    for k in keys:
        df.update(set(k.tolist()))
    n, mean = max(len(keys), 1), max(sum(map(len, keys)) / max(len(keys), 1), 1.0)
    postings = defaultdict(list)
    for doc, k in enumerate(keys):
        ks = k.tolist()
        tf = Counter(ks)
        impact = {}
        for key, f in tf.items():
            idf = np.log(1 + (n - df[key] + 0.5) / (df[key] + 0.5))
            impact[key] = float(idf * f * (K1 + 1) / (f + K1 * (1 - B + B * len(k) / mean)))
        if len(tf) == len(ks):
            least = sum(sorted(impact.values())[:SHARED])
        else:
            # repeated shingles count once in a query: any run of six words has two neighbours
            least = min(impact[a] + (impact[b] if b != a else 0.0) for a, b in zip(ks, ks[1:]))
        for key, v in impact.items():
            postings[key].append((doc, v / least))
    terms = sorted(postings)
    start, block_start, docs, impacts, last, most, top = [0], [0], [], [], [], [], []
    for t in terms:
        p = postings[t]
        docs += [x[0] for x in p]
        impacts += [x[1] for x in p]
        for s in range(0, len(p), POSTINGS):
            last.append(p[min(s + POSTINGS, len(p)) - 1][0])
            most.append(max(x[1] for x in p[s : s + POSTINGS]))
        top.append(max(most[block_start[-1] :]))
        start.append(len(docs))
        block_start.append(len(last))
    return {
        "terms": np.array(terms, np.uint64), "start": np.array(start, np.int64), "docs": np.array(docs, np.int32), "impacts": np.array(impacts, np.float32), "block_start": np.array(block_start, np.int64), "last": np.array(last, np.int32), "most": np.array(most, np.float32), "top": np.array(top, np.float32),
        "words": np.concatenate(texts) if texts else np.empty(0, np.uint64), "text_start": np.cumsum([0, *map(len, texts)], dtype=np.int64), "vocab": np.unique(np.concatenate(texts)) if texts else np.empty(0, np.uint64),
    }


def save(path: str, ids: list, arrays: dict[str, np.ndarray]) -> None:
    """One file: the length of a JSON header, the header, the arrays at multiples of 64 bytes."""
    at, spec = 0, {}
    for name, a in arrays.items():
        spec[name] = (at, a.dtype.str, len(a))
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"ids": ids, "arrays": spec}).encode()
    with open(path, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head + b"\0" * (-(8 + len(head)) % 64))
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 64))


class Part:
    """A part of the index, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            size = int.from_bytes(f.read(8), "little")
            head = json.loads(f.read(size))
        base = -(-(8 + size) // 64) * 64
        if os.path.getsize(path) > base:
            with open(path, "rb") as f:
                raw = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        else:
            raw = np.empty(base, np.uint8)
        self.ids = head["ids"]
        for name, (at, kind, n) in head["arrays"].items():
            item = np.dtype(kind).itemsize
            setattr(self, name, raw[base + at : base + at + n * item].view(kind))

    def text(self, doc: int) -> np.ndarray:
        return np.asarray(self.words[self.text_start[doc] : self.text_start[doc + 1]])

    def known(self, keys: np.ndarray) -> np.ndarray:
        """The term of each key, or -1."""
        if not len(self.terms):
            return np.full(len(keys), -1)
        spot = np.searchsorted(self.terms, keys)
        spot[spot == len(self.terms)] = 0
        return np.where(self.terms[spot] == keys, spot, -1)

    def search(self, terms: list[int]) -> list[int]:
        """Block-max WAND: the items whose relative impacts for the query add up to NEED."""
        docs, impacts, last, most, top = self.docs, self.impacts, self.last, self.most, self.top
        # a cursor: item, term, position, end, the bound of its whole list
        cursors = [[int(docs[self.start[t]]), t, int(self.start[t]), int(self.start[t + 1]), float(top[t])] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[4]
                if bound >= NEED:
                    pivot = i
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            ahead = cursors[: pivot + 1]
            # the blocks in which the item would be: their maxima decide whether it is looked at
            blocks = [self._block(c, doc) for c in ahead]
            if sum(float(most[b]) for b in blocks if b >= 0) >= NEED:
                if ahead[0][0] == doc:
                    if sum(float(impacts[c[2]]) for c in ahead) >= NEED:
                        found.append(doc)
                    target = doc + 1
                else:
                    target = doc
            else:
                # none up to the end of the nearest block, nor before the next list begins
                target = min(int(last[b]) + 1 for b in blocks if b >= 0) if any(b >= 0 for b in blocks) else doc + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, doc + 1)
            moved = []
            for i, c in enumerate(cursors):
                if i <= pivot and c[0] < target:
                    pos = c[2] + int(np.searchsorted(docs[c[2] : c[3]], target))
                    if pos >= c[3]:
                        continue
                    c = [int(docs[pos]), c[1], pos, c[3], c[4]]
                moved.append(c)
            cursors = moved
        return found

    def _block(self, c: list, doc: int) -> int:
        """The block of a cursor's list that would hold doc, from its place on; -1 behind the last."""
        first, end = int(self.block_start[c[1]]), int(self.block_start[c[1] + 1])
        now = first + (c[2] - int(self.start[c[1]])) // POSTINGS
        b = now if self.last[now] >= doc else now + int(np.searchsorted(self.last[now:end], doc))
        return b if b < end else -1


def parts(items: Iterable[tuple[object, str | None]], folder: str, part_bytes: int = PART_BYTES) -> Iterator[str]:
    """Write the parts of the index of (id, text) pairs into a folder, one after the other; what is held at a time is one part."""
    held: list[tuple[object, list[str]]] = []
    size = 0

    def write() -> str:
        path = os.path.join(folder, f"items-{uuid.uuid4().hex}.bin")
        save(path, [i for i, _ in held], pack(held))
        return path

    for i, text in items:
        w = words_of(text) if text else []
        if len(w) < LEAST:
            continue
        if held and size + len(w) * WORD_BYTES > part_bytes:
            yield write()
            held, size = [], 0
        held.append((i, w))
        size += len(w) * WORD_BYTES
    yield write()


def has_passage(item: np.ndarray, doc: np.ndarray, starts: np.ndarray | None = None) -> bool:
    """Whether doc holds at least LEAST consecutive words of item of which at most one in ONE_IN differs.

    Edit distances of the item's stretches from each start, growing word by word, against any stretch
    of doc; rows of all starts are computed at once, those beyond the bound are dropped.
    """
    n, width = len(item), len(doc)
    if n < LEAST or not width:
        return False
    starts = np.arange(n - LEAST + 1) if starts is None else starts
    col = np.arange(width + 1, dtype=np.int16)
    dist = np.zeros((len(starts), width + 1), np.int16)
    most = LONGEST // ONE_IN
    for length in range(1, min(LONGEST, n) + 1):
        keep = starts + length <= n
        if not keep.all():
            starts, dist = starts[keep], dist[keep]
        if not len(starts):
            return False
        word = item[starts + length - 1]
        new = np.empty_like(dist)
        new[:, 0] = length
        np.minimum(dist[:, :-1] + (word[:, None] != doc[None, :]), dist[:, 1:] + 1, out=new[:, 1:])
        new -= col
        np.minimum.accumulate(new, axis=1, out=new)
        new += col
        best = new.min(axis=1)
        if length >= LEAST and (best * ONE_IN <= length).any():
            return True
        keep = best <= most
        starts, dist = starts[keep], new[keep]
    return False


def leaks(part: Part, ids: np.ndarray, hit: np.ndarray, term: np.ndarray) -> list[int]:
    """The items of a part that a document holds; hit: positions of its known shingles, term: which they are."""
    found: set[int] = set()
    candidates: set[int] = set()
    # a stretch of known shingles is queried passage by passage
    first = hit[0] // STEP * STEP
    last_start = max(hit[-1] // STEP * STEP, first)
    for start in range(max(first - STEP, 0), last_start + 1, STEP):
        lo, hi = np.searchsorted(hit, (start, start + PASSAGE - SHINGLE + 1))
        if hi > lo:
            candidates.update(part.search(list(dict.fromkeys(term[lo:hi].tolist()))))
    keys = part.terms[term]
    for doc in candidates:
        text = part.text(doc)
        own = shingle_keys(text)
        order = np.argsort(own, kind="stable")
        left, right = np.searchsorted(own[order], keys, "left"), np.searchsorted(own[order], keys, "right")
        mine = sorted((int(p), int(q)) for p, a, b in zip(hit, left, right) for q in order[a:b])
        reach = LONGEST + LONGEST // ONE_IN + SHINGLE
        s = 0
        while s < len(mine) and doc not in found:
            e = s
            while e + 1 < len(mine) and mine[e + 1][0] - mine[e][0] <= 2 * reach:
                e += 1
            chunk = mine[s : e + 1]
            if len(chunk) >= SHARED and (_exact_run(chunk) or _near(text, ids, chunk, reach)):
                found.add(doc)
            s = e + 1
    return sorted(found)


def _exact_run(part: list[tuple[int, int]]) -> bool:
    """LEAST words in a row, unchanged: LEAST - SHINGLE + 1 neighbouring shingles on one diagonal."""
    by: dict[int, list[int]] = defaultdict(list)
    for p, q in part:
        by[p - q].append(p)
    need = LEAST - SHINGLE + 1
    for ps in by.values():
        run = 1
        for a, b in zip(ps, ps[1:]):
            run = run + 1 if b == a + 1 else 1
            if run >= need:
                return True
        if need <= 1:
            return True
    return False


def _near(text: np.ndarray, ids: np.ndarray, part: list[tuple[int, int]], reach: int) -> bool:
    lo, hi = max(part[0][0] - reach, 0), part[-1][0] + reach
    region = ids[lo:hi]
    known = np.isin(region, text)
    if known.sum() < LEAST - LONGEST // ONE_IN:
        return False
    qs = np.array(sorted({q for _, q in part}))
    starts = np.unique((qs[:, None] - np.arange(LONGEST)[None, :]).ravel())
    starts = starts[(starts >= 0) & (starts <= len(text) - LEAST)]
    if not len(starts):
        return False
    # long regions in overlapping pieces, so that memory stays bounded
    size = 1024
    for s in range(0, max(len(region) - reach, 1), size - reach):
        if has_passage(text, region[s : s + size], starts):
            return True
    return False


class Numbers(dict):
    """Word to its key, 0 for a word that no item has."""

    def __init__(self, index: list[Part]):
        super().__init__()
        # one part's vocabulary stays where it is mapped
        known = index[0].vocab if len(index) == 1 else np.unique(np.concatenate([p.vocab for p in index])) if index else np.empty(0, np.uint64)
        self.sorted = memoryview(known)

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        k = word_key(word)
        at = bisect.bisect_left(self.sorted, k)
        v = self[word] = k if at < len(self.sorted) and self.sorted[at] == k else 0
        return v


def scan(index: list[Part], texts: list[str | None], numbers: Numbers | None = None) -> list[list]:
    """The item ids that each text holds."""
    numbers = Numbers(index) if numbers is None else numbers
    out: list[list] = []
    for text in texts:
        found: list = []
        out.append(found)
        if not text:
            continue
        ids = np.fromiter(map(numbers.__getitem__, words_of(text)), np.uint64)
        keys = shingle_keys(ids)
        # a shingle with a word that no item has is none of the index
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        maybe = np.flatnonzero(unknown[SHINGLE:] == unknown[: len(keys)]) if len(keys) else keys
        if not len(maybe):
            continue
        k = keys[maybe]
        for part in index:
            term = part.known(k)
            ok = term >= 0
            if ok.any():
                found += [part.ids[d] for d in leaks(part, ids, maybe[ok], term[ok])]
    return out


@functools.lru_cache(maxsize=2)
def _opened(paths: tuple[str, ...]) -> tuple[list[Part], Numbers]:
    """The parts of an index, opened once a worker."""
    index = [Part(p) for p in paths]
    return index, Numbers(index)


def send(spark: SparkSession, items: Iterator[tuple[object, str | None]], part_bytes: int = PART_BYTES) -> list[str]:
    """Build the index where the driver runs and send its parts to the executors; returns their file names there."""
    folder = tempfile.mkdtemp(prefix="rateloom-items-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    names = []
    for path in parts(items, folder, part_bytes):
        spark.sparkContext.addFile(path)
        names.append(os.path.basename(path))
    return names


def find_leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc, item): each document with each item of which it holds a passage, once."""
    rows = items.select(item, item_text).where(F.col(item).isNotNull() & F.col(item_text).isNotNull())
    names = send(documents.sparkSession, ((r[0], r[1]) for r in rows.toLocalIterator()), part_bytes)
    key_type = items.schema[item].dataType.simpleString()
    doc_type = documents.schema[doc].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import SparkFiles

        index, numbers = _opened(tuple(SparkFiles.get(n) for n in names))
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for s in range(0, b.num_rows, 1024):
                found = scan(index, texts.slice(s, 1024).to_pylist(), numbers)
                at = [s + i for i, f in enumerate(found) for _ in f]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int32())), pa.array([x for f in found for x in f], _arrow_type(key_type))], names=[doc, item])

    return documents.where(F.col(doc).isNotNull()).select(doc, text).mapInArrow(run, f"`{doc}` {doc_type}, `{item}` {key_type}").distinct()


def _arrow_type(name: str):
    import pyarrow as pa

    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def leaked_items(found: DataFrame, doc: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Which items leaked and into how many documents."""
    return found.groupBy(item).agg(F.count(F.lit(1)).alias("documents"))
