"""Secret scans: fixed patterns, and values beside credential words that are costly to guess.

Every whole text is scanned once for the base patterns and for values in a credential context
(`pwd = x`, `Bearer x`, `//user:x@host`, `--passphrase x`, `<password>x</password>`, ...). The distinct values
are priced: the cheapest way to segment a value into dictionary words, dates, years, repeats,
keyboard walks and brute-force spans, in bits of guesses. Values of MIN_BITS or more are
secrets; `changeme`, `qwerty123` or `2019-01-31` are not.

The dictionary is the corpus itself: a word costs log2(words / its count), counted over all
texts. It is never broadcast: the words inside values (the values' letter runs cut to all
substrings of 3 to MAX_WORD letters) are joined with the counts. A value that many documents
hold is priced once.

Defined results: a null or empty text has no spans; positions are code points, ends exclusive;
a value within a base span adds nothing; rows that repeat or share an id are scanned each
for itself, a null id included; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.llm.tables import stored

# The base patterns, in the order in which their kinds are listed, and the least
# length of what must be long enough.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of maximal runs, those long enough
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")
MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# What stands before a value that may be a credential.
CONTEXTS = [
    re.compile(
        r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|auth|private|client|account|signing|encryption)[_\x20-]?(?:key|token|secret)|authorization|login)["'\])>]*(?:\x20*(?::=|=>|->|=|:)|\x20+is:?\x20|>|(?<=[>])|\x20*\t)\x20*(?:bearer\x20+|basic\x20+)?["'`]?([!#-&(-;=?-_a-~]{6,})""",
        re.IGNORECASE | re.ASCII,
    ),
    re.compile(r"""--(?:password|passwd|passphrase|pass|pwd|token|secret)[=\x20]["']?([!#-&(-;=?-_a-~]{6,})""", re.IGNORECASE | re.ASCII),
    re.compile(r"""\b(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]{6,})""", re.IGNORECASE | re.ASCII),
    re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@", re.ASCII),
]
CONTEXT_MARKS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "login", "bearer", "basic", "://")
_TRAILING = ".,;:!?)]}"

# --- pricing ---------------------------------------------------------------------

MIN_BITS = 40.0
MIN_WORD, MAX_WORD = 3, 24
MAX_PERIOD = 24
YEARS = 150

# The rows of a keyboard, unshifted and shifted, and the alphabet as one more row.
KEY_ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
SHIFTED_ROWS = ["~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?"]
# Letters that are commonly written as other signs.
LEET = {"4": "a", "@": "a", "3": "e", "1": "l", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}
_UNLEET = str.maketrans(LEET)

_DATES = [
    re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\1(?:19|20)?\d\d"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d"),
]
_YEAR = re.compile(r"(?:19|20)\d\d")
DATE_BITS = math.log2(366 * YEARS)
YEAR_BITS = math.log2(YEARS)


@cache
def _places() -> dict[str, tuple[int, int, bool]]:
    """Row, column in half keys and shift of each key."""
    rows = [(r, row, s) for s, keys in ((False, KEY_ROWS), (True, SHIFTED_ROWS)) for r, row in enumerate(keys)]
    return {key: (r, 2 * c + r, shifted) for r, row, shifted in rows for c, key in enumerate(row)}


def _step(a: str, b: str) -> tuple[int, int] | None:
    """The direction from a key to its neighbour, or along the alphabet."""
    if a.isalpha() and b.isalpha() and abs(ord(a) - ord(b)) == 1:
        return (9, ord(b) - ord(a))
    here, there = _places().get(a), _places().get(b)
    if here is None or there is None:
        return None
    step = (there[0] - here[0], there[1] - here[1])
    return step if step in ((0, 2), (0, -2), (1, 1), (1, -1), (-1, 1), (-1, -1)) else None


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, bits) of runs of neighbouring keys: a start, and a choice at each turn."""
    keys = len(_places())
    for start in range(len(value) - 2):
        bits, last = math.log2(keys), None
        for end in range(start + 1, len(value)):
            step = _step(value[end - 1], value[end])
            if step is None:
                break
            bits += math.log2(6) + 1 if step != last else 0.25
            last = step
            if end - start >= 2:
                yield start, end + 1, bits
            if end - start >= MAX_WORD:  # a longer walk is several
                break


def _repeats(value: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, period): maximal runs of a block, from each of the block's rotations."""
    for period in range(1, min(MAX_PERIOD, len(value) // 2) + 1):
        run = 0
        for i in range(len(value) - period + 1):
            if i + period < len(value) and value[i] == value[i + period]:
                run += 1
                continue
            if run >= period:
                first = i - run
                for start in range(first, min(first + period, i - period + 1)):
                    yield start, start + (i + period - start) // period * period, period
            run = 0


def _alphabet(value: str) -> int:
    """How many signs a guesser has to try per place."""
    classes = ((r"\d", 10), (r"[a-z]", 26), (r"[A-Z]", 26), (r"[^0-9A-Za-z]", 33))
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) and re.search(r"[A-Fa-f]", value) and re.search(r"\d", value)
    return 16 if hexadecimal else sum(n for pattern, n in classes if re.search(pattern, value))


def _variant_bits(written: str) -> float:
    """Choices of capitals and of signs in place of letters."""
    capitals, signs = sum(c.isupper() for c in written), sum(c in LEET for c in written)
    usual = capitals == 0 or written[0].isupper() and capitals == 1 or written.isupper()
    return (capitals > 0) * (1 if usual else math.log2(math.comb(len(written), capitals) + 1)) + 1.5 * signs


def word_spans(value: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, word) of every substring that is letters, or signs for letters, in lower case."""
    plain = value.translate(_UNLEET).lower()
    for run in re.finditer(r"[a-z]+", plain) if plain.isascii() else ():
        for start in range(run.start(), run.end() - MIN_WORD + 1):
            if value[start : start + MIN_WORD].isdigit():
                continue
            for end in range(start + MIN_WORD, min(run.end(), start + MAX_WORD) + 1):
                yield start, end, plain[start:end]


def guess_bits(value: str, words: dict[str, float], depth: int = 0) -> float:
    """log2 of the guesses of the cheapest segmentation; `words` has the bits of known words."""
    n = len(value)
    into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for start, end, word in word_spans(value):
        if word in words:
            into[end].append((start, words[word] + _variant_bits(value[start:end])))
    for start, end, bits in _walks(value):
        into[end].append((start, bits))
    for pattern in _DATES:
        for found in pattern.finditer(value):
            into[found.end()].append((found.start(), DATE_BITS + 2 * bool(pattern.groups and found[1])))
    for found in _YEAR.finditer(value):
        into[found.end()].append((found.start(), YEAR_BITS))
    if depth == 0:
        prices: dict[str, float] = {}
        for start, end, period in _repeats(value):
            block = value[start : start + period]
            if block not in prices:
                prices[block] = guess_bits(block, words, 1)
            into[end].append((start, prices[block] + math.log2((end - start) // period) + 1))
    per_sign = math.log2(max(2, _alphabet(value)))
    best = [0.0] + [math.inf] * n
    for end in range(1, n + 1):
        best[end] = best[end - 1] + per_sign
        for start, bits in into[end]:
            # One more bit for where the segment ends.
            best[end] = min(best[end], best[start] + bits + 1)
    return best[n]


# --- scanning ---------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, in order."""
    lowered = text.lower()
    found = []
    if any(m in lowered for m in MARKS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def context_values(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of values in a credential context that no base span covers; of
    overlapping ones the earliest, then the longest."""
    lowered = text.lower()
    if not any(m in lowered for m in CONTEXT_MARKS):
        return []
    found = []
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            value = m[1].rstrip(_TRAILING)
            found.append((m.start(1), -(m.start(1) + len(value)), value))
    out, last = [], 0
    for start, end, value in sorted(found):
        end = -end
        if start >= last and len(value) >= LEAST_ASSIGNED and not any(a <= start and end <= b for a, _, b in base):
            out.append((start, end, value))
            last = end
    return out


_SPANS = "array<struct<start:int,kind:string,end:int>>"
_SCANNED = (
    f"row long, doc_id long, n_assign long, n_access long, n_hex long, base {_SPANS}, "
    "found array<struct<start:int,end:int,value:string>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:3]],
        ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))),
        ("found", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))),
    ])
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            text = text.as_py() or ""
            base = base_spans(text)
            counts = {f"n_{k}": sum(kind == k for _, kind, _ in base) for k in KINDS[:3]}
            found = [dict(zip(("start", "end", "value"), f, strict=True)) for f in context_values(text, base)]
            spans = [dict(zip(("start", "kind", "end"), b, strict=True)) for b in base]
            rows.append({"row": row, "doc_id": doc_id.as_py(), **counts, "base": spans, "found": found})
            row += 1
        yield pa.RecordBatch.from_pylist(rows, schema)


def scanned(docs: DataFrame) -> DataFrame:
    """Base spans and candidate values of every row, which gets a number of its own."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan, _SCANNED)


def word_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every run of 3 to MAX_WORD letters a to z in all lower-cased texts."""
    words = F.explode(F.split(F.lower(F.col("text").cast("string")), "[^a-z]+"))
    words = docs.select(words.alias("word")).where(F.length("word").between(MIN_WORD, MAX_WORD))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@arrow_udf(T.ArrayType(T.StringType()))
def _words_in(values: pa.Array) -> pa.Array:
    return pa.array([sorted({w for _, _, w in word_spans(v)}) for v in values.to_pylist()], pa.list_(pa.string()))


def priced(values: DataFrame, counts: DataFrame) -> DataFrame:
    """value, bits of each distinct value."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = values.select("value", F.explode(_words_in("value")).alias("word"))
    known = inside.join(counts, "word").groupBy("value").agg(F.collect_list(F.struct("word", "n")).alias("words"))

    @arrow_udf(T.DoubleType())
    def bits(texts: pa.Array, words: pa.Array) -> pa.Array:
        prices = [{w["word"]: math.log2(max(2.0, total / w["n"])) for w in known or ()} for known in words.to_pylist()]
        return pa.array([guess_bits(t, p) for t, p in zip(texts.to_pylist(), prices, strict=True)], pa.float64())

    return values.join(known, "value", "left").select("value", bits("value", "words").alias("bits"))


def find_secrets(docs: DataFrame, min_bits: float = MIN_BITS) -> DataFrame:
    """row, doc_id, counts, base spans, all spans; a span is (start, kind, end)."""
    rows = stored(scanned(docs), "secret-scan")
    held = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("f"))
    values = stored(held.select("f.value").distinct(), "secret-values")
    counts = stored(word_counts(docs), "secret-words")
    costly = priced(values, counts).where(F.col("bits") >= min_bits)
    span = F.struct(F.col("f.start").alias("start"), F.lit("guess").alias("kind"), F.col("f.end").alias("end"))
    added = held.join(costly, F.col("f.value") == F.col("value")).groupBy("row").agg(F.collect_list(span).alias("added"))
    # A text's own values meet again; rows without any pass by the join.
    with_values = rows.where(F.size("found") > 0).join(added, "row", "left")
    every = with_values.unionByName(rows.where(F.size("found") == 0).withColumn("added", F.lit(None).cast(_SPANS)))
    return every.withColumn("spans", F.concat("base", F.coalesce("added", F.array().cast(_SPANS)))).drop("added", "found")


def listed(spans: str) -> Column:
    """kind:start:end by start, then kind in the order of KINDS, comma-joined."""
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("at"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    return find_secrets(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )
