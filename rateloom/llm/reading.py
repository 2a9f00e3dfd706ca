"""Problem 10: the reading level of each document.

Prose (comments, docstrings, and in text files all outside fenced code) is taken out of every
document once and written as a table. What a file is follows from its content where that contradicts its ending: a text
file whose lines are mostly code is read as code, a code file whose lines outside comments are mostly sentences as text.

Interpolated character n-gram models of orders one to five over all of Unicode are trained on the prose of all documents:
words are counted first, their n-grams second, so nothing but words and n-grams is shuffled. An n-gram is kept from a share
of KEEP of all signs on, hence at most 1 / KEEP of each order, whatever the corpus; contexts are weighted by
Witten and Bell's rule. The surprisal of a document's words in bits, over its full prose, gives its distribution:
mean, 10th, 50th and 90th percentile of the words, and the mean of its sentences. The latter is mapped to graded
difficulty by an isotonic regression fitted on at most MOST_LABELS labelled documents.

`floor_of_long_words` proves how low the surprisal of prose with long words can be: every word of the corpus is in the
counted vocabulary, so the mean over any words averaging L letters is at least the least value of bits - m (letters - L)
over the vocabulary, for any m >= 0. The curve is monotone, so its value there is a level that no document of such prose
is below, however the corpus and its labels look.

Defined results: a document without prose words has no level (null), nor has any without labels. Null and empty texts, and
unknown file names, are documents without prose or code files respectively. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize

#: Labelled documents used to fit the regression, at most.
MOST_LABELS = 20_000
#: Highest order of the model, and the share of all signs from which an n-gram is kept.
ORDER, KEEP = 5, 2.0**-16
#: Words a worker remembers the surprisal of, or counts, before it starts anew.
REMEMBERED = 500_000
TEXT_ENDINGS = frozenset(("md", "markdown", "txt", "rst"))
TEXT_NAMES = re.compile(r"(?i)^(licen[cs]e|copying|notice|readme)\b")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_END = re.compile(r"(?<![.!?])[.!?]++(?=\s|$)")
_LINE = re.compile(r"[ \t]*(?://+!?|--+(?=\s|$)|#+(?=\s|$)|;+(?=\s|$))(.*)")
_BREAK = re.compile(r"\r\n|\r|\n")
_CODE = re.compile(r"[;{}]\s*$|^\s*(?:import|from|def|class|package|export|const|let|var|func|fn|pub|use|return|if|for|while|public|private|static|select|insert|update|create|alter|#include)\b.*[(){};=:\"'.]|^\s*[\w.$]+\s*(?:=|\(|:\s*\S+$)|[(\[{]\s*$")
#: A line of a sentence: four plain words in a row at its beginning, behind a list mark or not.
_SENTENCE = re.compile(r"\s*(?:[-*>]\s+|\(?\d+[.)]\s+)?(?:[(\"'“‘]*[^\W\d_]+(?:['’-][^\W\d_]+)*[.,;:!?)\"'”’]*\s+){3}[(\"'“‘]*[^\W\d_]")
#: A docstring's opening, and a comment behind code once its strings are taken out.
_DOC = re.compile(r"[rRuUbBfF]{0,2}(\"{3}|'{3})")
_STRING = re.compile(r"\"(?:\\.|[^\"\\])*+\"|'(?:\\.|[^'\\])*+'|`[^`]*+`")
_BEHIND = re.compile(r"\s(?://+|#+|--+)\s+(.*)|\s/\*+(.*?)(?:\*/|$)")


def looks_like_code(lines: list[str]) -> bool:
    """Whether most lines outside fences are code; tells text files with a wrong ending."""
    code = prose = 0
    for s in lines:
        if not s.strip() or _LINE.match(s):
            continue
        if _CODE.search(s):
            code += 1
        elif s.count(" ") >= 3:
            prose += 1
    return code > prose


def looks_like_text(rest: list[str]) -> bool:
    """Whether most lines outside fences and comments are sentences; tells code files with a wrong ending."""
    prose = sum(1 for s in rest if not _CODE.search(s) and _SENTENCE.match(s))
    return 2 * prose > len(rest)


def _unfenced(lines: list[str]) -> list[str]:
    out, fence = [], None
    for s in lines:
        mark = s.lstrip()[:3]
        if mark in ("```", "~~~") and fence in (None, mark):
            fence = mark if fence is None else None
        elif fence is None:
            out.append(s)
    return out


def prose_of(text: str, path: str | None) -> str:
    """The prose of a file, one piece a line."""
    name = (path or "").rsplit("/", 1)[-1]
    ending = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    lines = _BREAK.split(text)
    fenced = "```" in text or "~~~" in text
    outside = _unfenced(lines) if fenced else lines
    if ending in TEXT_ENDINGS or (not ending and TEXT_NAMES.match(name)):
        if not looks_like_code(outside):
            return "\n".join(outside)
        return "\n".join(_read(lines)[0])
    comments, rest = _read(outside)
    if looks_like_text(rest):
        return "\n".join(outside)
    return "\n".join(_read(lines)[0] if fenced else comments)


def _read(lines: list[str]) -> tuple[list[str], list[str]]:
    """(prose of comments and docstrings, lines of neither) of a code file."""
    out: list[str] = []
    rest: list[str] = []
    close = None
    for k, line in enumerate(lines):
        s = line.strip()
        if close:
            inner, end, behind = s.partition(close)
            out.append(inner.lstrip("*").strip())
            if end:
                close = None
                out.append("")
                if behind.strip():
                    rest.append(behind)
            continue
        if not s or (k == 0 and s.startswith("#!")):
            continue
        if m := _DOC.match(s):
            inner, end, _ = s[m.end() :].partition(m[1])
            out.append(inner)
            close = None if end else m[1]
        elif s[:2] == "/*":
            inner, end, _ = s[2:].lstrip("*").partition("*/")
            out.append(inner)
            close = None if end else "*/"
        elif s[:4] == "<!--":
            inner, end, _ = s[4:].partition("-->")
            out.append(inner)
            close = None if end else "-->"
        elif m := _LINE.match(line):
            out.append(m.group(1))
        else:
            rest.append(line)
            if "//" in s or "# " in s or "-- " in s or "/*" in s:
                code = _STRING.sub("''", s)
                if m := _BEHIND.search(code):
                    out.append(m[1] if m[1] is not None else m[2])
                    if m[1] is None and "*/" not in code[m.start() :]:
                        close = "*/"
    return out, rest


def measure(prose: str) -> tuple[int, int, int, str]:
    """(words, sentences, letters, words joined by blanks in lower case)."""
    words = _WORD.findall(prose)
    letters = sum(map(len, words)) - sum(w.count("'") + w.count("’") + w.count("-") for w in words if not w.isalpha())
    sentences, last = 0, 0
    for m in _END.finditer(prose):
        if _WORD.search(prose, last, m.start()):
            sentences += 1
            last = m.end()
    if words and _WORD.search(prose, last):
        sentences += 1
    return len(words), sentences, letters, " ".join(words).lower()


def extract_prose(documents: DataFrame, doc: str = "doc_id", text: str = "text", path: str = "path") -> DataFrame:
    """(doc, words, sentences, letters, prose): the whole text of every document is read."""
    kind = documents.schema[doc].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                rows = [measure(prose_of(t, p)) if t else (0, 0, 0, "") for t, p in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=[doc, "words", "sentences", "letters", "prose"])

    return documents.select(doc, text, path).mapInArrow(run, f"`{doc}` {kind}, words bigint, sentences bigint, letters bigint, prose string")


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, level) of the least-squares non-decreasing fit, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        blocks.append([float(b), 1.0, float(a), float(a)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, n, _, hi = blocks.pop()
            u, m, lo, _ = blocks.pop()
            blocks.append([(u * m + v * n) / (m + n), m + n, lo, hi])
    xs = [e for b in blocks for e in (b[2], b[3])]
    ys = [b[0] for b in blocks for _ in (0, 1)]
    return np.array(xs), np.array(ys)


def vocabulary(prose: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs, counted within partitions first."""

    def run(batches):
        import pyarrow as pa

        seen: Counter = Counter()

        def table():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(t.split(" "))
            if len(seen) > REMEMBERED:
                yield table()
                seen.clear()
        yield table()

    return prose.select("prose").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame, order: int = ORDER, keep: float = KEEP) -> dict[str, int]:
    """Counts of the kept n-grams; \\x02 and \\x03 are the edges of a word. At most order / keep reach the driver."""
    t = words.select("n", F.concat(F.lit("\x02"), "word", F.lit("\x03")).alias("t"))
    grams = f"flatten(transform(sequence(1, length(t) - 1), i -> transform(sequence(1, least({order}, i + 1)), k -> substring(t, i - k + 2, k))))"
    signs = t.agg(F.sum(F.col("n") * (F.length("t") - 1))).first()[0] or 0
    counts = t.select("n", F.explode(F.expr(grams)).alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counts.where(F.col("n") >= F.lit(keep * signs)).collect()}


class Model:
    """Interpolated n-gram model of the signs of a word.

    The probability of a sign after a context is that of the kept n-grams, mixed with that after the shorter context
    with weights of the context's kept occurrences against its kept kinds of signs. Signs that are not kept share the
    place of one. A context adds up to 1 over all signs and that place.
    """

    def __init__(self, counts: dict[str, int], order: int = ORDER):
        self.order = order
        total: Counter = Counter()
        kinds: Counter = Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        self.rest = {c: kinds[c] / (total[c] + kinds[c]) for c in total}
        self.gain = {g: n / (total[g[:-1]] + kinds[g[:-1]]) for g, n in counts.items()}
        self.base = 1.0 / (kinds[""] + 1)

    def chance(self, context: str, sign: str) -> float:
        p = self.base
        for k in range(self.order):
            if k > len(context):
                break
            c = context[len(context) - k :]
            rest = self.rest.get(c)
            if rest is None:
                break
            p = p * rest + self.gain.get(c + sign, 0.0)
        return p

    def bits(self, word: str) -> float:
        """Surprisal of a word with its closing edge."""
        t = f"\x02{word}\x03"
        p = [self.chance(t[max(0, i - self.order + 1) : i], t[i]) for i in range(1, len(t))]
        return -float(np.log2(p).sum())


class Memory(dict):
    """Surprisals of words, each evaluated once a worker."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        v = self[word] = self.model.bits(word)
        return v


_MEMORY: dict[int, Memory] = {}


def _memory(shared) -> Memory:
    """The worker's memory of a broadcast model."""
    if shared.jid not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[shared.jid] = Memory(shared.value)
    return _MEMORY[shared.jid]


class Shared:
    """A broadcast model with a number by which workers know it."""

    def __init__(self, spark, model: Model):
        self.broadcast = spark.sparkContext.broadcast(model)
        self.jid = self.broadcast._jbroadcast.id() if self.broadcast._jbroadcast is not None else 0

    def __getstate__(self):
        return {"broadcast": self.broadcast, "jid": self.jid}

    @property
    def value(self) -> Model:
        return self.broadcast.value


BITS = ("bits", "bits_p10", "bits_p50", "bits_p90", "sentence_bits")


def surprisals(prose: DataFrame, shared: Shared, knots: tuple[np.ndarray, np.ndarray] | None = None, doc: str = "doc_id") -> DataFrame:
    """(doc, words, sentences, letters, bits, bits_p10, bits_p50, bits_p90, sentence_bits, level): the distribution over a document's words, its mean a sentence, and that on the fitted curve."""
    kind = prose.schema[doc].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        memory = _memory(shared)
        for b in batches:
            out = np.full((b.num_rows, 6), np.nan)
            for i, (p, s) in enumerate(zip(b.column(4).to_pylist(), b.column(2).to_pylist())):
                if p:
                    w = np.array([memory[x] for x in p.split(" ")])
                    w.sort()
                    out[i, :5] = (w.mean(), *w[[len(w) // 10, len(w) // 2, len(w) * 9 // 10]], w.sum() / max(s, 1))
            if knots is not None:
                out[:, 5] = np.interp(out[:, 4], *knots)
            cols = [pa.array(c, pa.float64(), from_pandas=True) for c in out.T]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *cols], names=[doc, "words", "sentences", "letters", *BITS, "level"])

    numbers = ", ".join(f"{c} double" for c in (*BITS, "level"))
    return prose.select(doc, "words", "sentences", "letters", "prose").mapInArrow(run, f"`{doc}` {kind}, words bigint, sentences bigint, letters bigint, {numbers}")


def floor_of_long_words(words: DataFrame, shared: Shared, letters: float, slopes: int = 61, steepest: float = 6.0) -> float:
    """A bound below which no prose of the counted words that averages at least so many letters has its mean surprisal a word.

    One pass over the vocabulary; what leaves a task is one number for each slope.
    """
    grid = np.linspace(0.0, steepest, slopes)

    def run(batches):
        import pyarrow as pa

        memory = _memory(shared)
        least = np.full(slopes, np.inf)
        for b in batches:
            ws = [w for w in b.column(0).to_pylist() if w]
            if ws:
                bits = np.array([memory[w] for w in ws])
                size = np.array([len(w) - w.count("'") - w.count("’") - w.count("-") for w in ws], float)
                for k, m in enumerate(grid):
                    least[k] = min(least[k], (bits - m * (size - letters)).min())
        yield pa.RecordBatch.from_arrays([pa.array(range(slopes), pa.int32()), pa.array(least, pa.float64())], names=["slope", "least"])

    low = words.select("word").mapInArrow(run, "slope int, least double").groupBy("slope").agg(F.min("least").alias("least")).agg(F.max("least")).first()[0]
    # room for the order of additions
    return -np.inf if low is None else max(float(low) * (1 - 1e-9) - 1e-6, 0.0)


@dataclass
class Levels:
    """rows: (doc, words, sentences, letters, bits..., level). knots of the fitted curve, None without labels; words and shared: vocabulary and model."""

    rows: DataFrame
    knots: tuple[np.ndarray, np.ndarray] | None
    words: DataFrame
    shared: Shared

    def demanding(self, words_a_sentence: float, letters_a_word: float) -> DataFrame:
        """The rows from the level on that prose of such long sentences and words cannot be below; without labels from the surprisal on."""
        least = words_a_sentence * floor_of_long_words(self.words, self.shared, letters_a_word)
        if self.knots is None:
            return self.rows.where(F.col("sentence_bits") >= least)
        return self.rows.where(F.col("level") >= float(np.interp(least, *self.knots)) - 1e-9)


def reading_levels(documents: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", path: str = "path", most: int = MOST_LABELS) -> Levels:
    """Levels from 1 to 5, null without prose."""
    prose = materialize(extract_prose(documents, doc, text, path), "prose")
    words = materialize(vocabulary(prose), "vocabulary")
    shared = Shared(prose.sparkSession, Model(count_grams(words)))
    graded = labels.select(doc, F.col("level").alias("_grade")).where("_grade is not null").orderBy(F.xxhash64(doc), doc).limit(most)
    known = prose.join(F.broadcast(graded.select(doc).distinct()), doc, "left_semi")
    sample = surprisals(known, shared, None, doc).where("sentence_bits is not null").join(F.broadcast(graded), doc).select("sentence_bits", "_grade").collect()
    knots = isotonic(np.array([r[0] for r in sample]), np.array([r[1] for r in sample], float)) if sample else None
    return Levels(surprisals(prose, shared, knots, doc), knots, words, shared)
