"""Personal data: fixed formats seed a bootstrapped search for identifiers in the same contexts.

Base spans are matches of four fixed formats: `email`, `ip`, `card`, `phone`.
They seed the bootstrap. A lexical pattern is the word, or the two words, before
an identifier. An instance is an identifier's normalised value. Candidates are
the words that hold digits or "@", are shaped like a kind, and lie in no base
span. Spark builds the graph of patterns and instances from all documents and
scores it `ROUNDS` times: a pattern's score is the summed confidence of its
instances over everything it precedes, ordinary words included; an unseen
instance's confidence is the noisy-or of its patterns. Candidates after a
pattern of score `SURE` or more, with `SUPPORT` seeds at least, become spans.

How often a context precedes anything at all is counted over all distinct texts, for
the contexts in a Bloom filter of fixed size (1 MiB) that holds all patterns;
the false ones drop out when the counts are joined.

Offsets are code points, ends exclusive. Null texts count as empty and have no
spans. Repeated rows get the same spans. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import bytes_of, frugal, kept, mix, pieces, strings, word_hashes

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SURE = 0.7
SUPPORT = 3
FILTER_BITS = 1 << 23

# The four formats.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9][0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words with a digit or "@"; numbers set apart by single spaces belong together.
_CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*(?:\x20[0-9(][0-9().-]+(?![^\x20\x09-\x0D]))*")
_TRIM = re.compile(r"^[^0-9A-Za-z(+]+|[^0-9A-Za-z)]+$")
_NOT_DIGIT = re.compile(r"[^0-9]")
_BEFORE = re.compile(r"(?:([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+)?([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+\Z")
_PHONE_SHAPE = re.compile(r"[+(]?[0-9][0-9().\x20-]*\Z")
_DIGIT = re.compile("[0-9]")
_ONE, _TWO_A, _TWO_B = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))

Span = tuple[int, int, int]  # kind number, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the four formats, by kind and start."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _octets(ip: str) -> bool:
    # Leading zeros may make a part long; only its value counts.
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in ip.split("."))


def shape(value: str) -> int | None:
    """The kind a candidate could be, by its letters and digits alone."""
    if "@" in value:
        left, _, right = value.partition("@")
        return 0 if left and right else None
    if not _PHONE_SHAPE.match(value):
        return None
    digits = len(_NOT_DIGIT.sub("", value))
    if value.count(".") == 3 and digits <= 16 and "-" not in value:
        return 1
    if 13 <= digits <= 19:
        return 2
    return 3 if 7 <= digits <= 12 else None


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Identifier-shaped words outside of base spans."""
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    out = []
    for m in _CANDIDATE.finditer(text):
        value, start = m[0], m.start()
        lead = _TRIM.match(value)
        if lead and lead.end() < len(value):
            value, start = value[lead.end() :], start + lead.end()
        value = _TRIM.sub("", value)
        kind = shape(value)
        end = start + len(value)
        before = bisect_left(starts, end)
        if kind is not None and not (before and reach[before - 1] > start):
            out.append((kind, start, end))
    return out


def _contexts(text: str, spans: list[Span]) -> list[str]:
    """The one or two words before the word that a span begins in, lower case; "" if there is none."""
    out = []
    for _, start, _ in spans:
        while start > 0 and text[start - 1] not in " \t\n\v\f\r":
            start -= 1
        # Two words of ordinary length; a longer one leaves only what is certain.
        m = _BEFORE.search(text, max(0, start - 200), start)
        cut = m is not None and m.start() > 0 and text[m.start() - 1] not in " \t\n\v\f\r"
        # Of two words only the first can be cut.
        out.append("" if m is None or (cut and m[1] is None) else text[m.start(2) : m.end()] if cut else m[0])
    return out


def _pattern_hashes(contexts: list[str]) -> list[list[int]]:
    """Hashes of the last word and of the last two words of each context."""
    hashes, at = word_hashes(*bytes_of(pa.array(contexts, pa.string())))
    out = []
    for a, b in zip(at[:-1], at[1:]):
        own = hashes[a:b][-2:]
        found = [mix(own[-1:] * _ONE)] if len(own) else []
        if len(own) == 2:
            found.append(mix(own[:1] * _TWO_A + own[1:] * _TWO_B))
        out.append([int(f.view(np.int64)[0]) for f in found])
    return out


_OCCURRENCE = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
    ("instance", pa.int64()), ("patterns", pa.list_(pa.int64())),
]))
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_READ_SCHEMA = (
    "doc_id long, text_key long, base array<struct<kind:int,start:int,end:int>>, base_sha256 string, "
    "found array<struct<kind:int,start:int,end:int,seed:boolean,instance:bigint,patterns:array<bigint>>>"
)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text"):
            rows = strings(batch.column("text"))
            bases, founds, contexts = [], [], []
            for text in rows:
                base = base_spans(text)
                more = candidates(text, base) if _DIGIT.search(text) or "@" in text else []
                spans = [(s, True) for s in base] + [(s, False) for s in more]
                bases.append(base)
                founds.append(spans)
                contexts += _contexts(text, [s for s, _ in spans])
            patterns = iter(_pattern_hashes(contexts))
            occurrences = [
                [
                    {
                        "kind": k, "start": a, "end": b, "seed": seed, "patterns": next(patterns),
                        "instance": _signed(xxhash.xxh64_intdigest(f"{k}:{_plain(text[a:b])}")),
                    }
                    for (k, a, b), seed in spans
                ]
                for text, spans in zip(rows, founds)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"),
                    pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in base] for base in bases], _SPANS),
                    pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base in bases]),
                    pa.array(occurrences, _OCCURRENCE),
                ],
                ["doc_id", "text_key", "base", "base_sha256", "found"],
            )


def _plain(value: str) -> str:
    return value.lower() if "@" in value else re.sub(r"[^0-9.]", "", value)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _count_contexts(bits):
    """Sum, per partition, how often each context of the filter precedes a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(receive(bits), np.uint8), bitorder="little").view(bool)
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            keys, place = np.unique(np.concatenate(held), return_inverse=True)
            n = np.bincount(place, np.concatenate(counts)).astype(np.int64)
            held.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["pattern", "n"])

        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                hashes, at = word_hashes(*bytes_of(batch.column("text")))
                follows = np.ones(len(hashes), bool)  # whether a word of the same text follows
                follows[at[1:][at[1:] > at[:-1]] - 1] = False
                two = follows.copy()
                two[at[:-1][at[:-1] < len(hashes)]] = False
                one = mix(hashes[follows] * _ONE)
                place = np.flatnonzero(two)
                both = mix(hashes[place - 1] * _TWO_A + hashes[place] * _TWO_B)
                keys = np.concatenate((one, both))
                keys = keys[table[(keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)]]
                keys, n = np.unique(keys, return_counts=True)
                held.append(keys)
                counts.append(n)
                if sum(map(len, held)) > 500_000:
                    yield emit()
        if held:
            yield emit()
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def read(docs: DataFrame) -> DataFrame:
    """Base spans and candidate occurrences of every document, kept for the rounds that follow."""
    return kept(_keyed(docs).mapInArrow(frugal(_read), _READ_SCHEMA))


def sure_patterns(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`pattern`, `kind` and `score` of the patterns to trust."""
    spark = docs.sparkSession
    # One row per text, so that copies of a document do not vouch for each other.
    occurrences = found.where(F.size("found") > 0).dropDuplicates(["text_key"]).select(
        F.explode("found").alias("o")
    ).select("o.kind", "o.seed", "o.instance", F.explode("o.patterns").alias("pattern"))
    edges = kept(
        occurrences.groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    )
    supported = kept(
        edges.groupBy("pattern", "kind").agg(
            F.count(F.when(F.col("seed"), 1)).alias("seeds"), F.count(F.when(~F.col("seed"), 1)).alias("others"),
            F.sum("n").alias("n"),
        ).where((F.col("seeds") >= SUPPORT)),
    )
    # The filter: FILTER_BITS bits, in pieces of 32,768.
    bit = F.col("pattern").bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = supported.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32768).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits")
    ).collect()
    bits = bytearray(FILTER_BITS // 8)
    for part, piece in parts:
        bits[part * 4096 : part * 4096 + len(piece)] = piece
    shared = send(spark, bytes(bits))
    # Over the same texts as `n`, each once.
    once = _keyed(docs).dropDuplicates(["text_key"]).select("text")
    totals = once.mapInArrow(frugal(_count_contexts(shared)), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    patterns = kept(
        supported.join(totals, "pattern", "left").withColumn("rest", F.greatest(F.coalesce("total", F.lit(0)) - F.col("n"), F.lit(0))),
    )
    graph = kept(edges.join(patterns.select("pattern", "kind"), ["pattern", "kind"], "left_semi"))
    sure = graph.select("kind", "instance", "seed").groupBy("kind", "instance").agg(
        F.max(F.col("seed").cast("double")).alias("confidence")
    )
    scored = None
    for i in range(ROUNDS):
        sums = graph.join(sure, ["kind", "instance"]).groupBy("pattern", "kind").agg(
            F.sum("confidence").alias("sure"), F.count("*").alias("instances"))
        scored = kept(
            patterns.join(sums, ["pattern", "kind"]).withColumn(
                "score", F.col("sure") / (F.col("instances") + F.col("rest") + 1)
            ),
        )
        sure = kept(
            graph.join(scored.select("pattern", "kind", "score"), ["pattern", "kind"]).groupBy("kind", "instance").agg(
                F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("confidence")
            ),
        )
    return scored.where(F.col("score") >= SURE).select("pattern", "kind", "score")


def discovered(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`text_key` and the spans that patterns add, for the texts that have some."""
    patterns = sure_patterns(docs, found)
    loose = found.where(F.exists("found", lambda o: ~o["seed"])).dropDuplicates(["text_key"]).select(
        "text_key", F.explode(F.filter("found", lambda o: ~o["seed"])).alias("o")
    ).select("text_key", "o.kind", "o.start", "o.end", F.explode("o.patterns").alias("pattern"))
    return kept(
        loose.join(patterns, ["pattern", "kind"], "left_semi").groupBy("text_key").agg(
            F.collect_set(F.struct("kind", "start", "end")).alias("more")
        ),
    )


def _equals(i: int) -> Callable[[Column], Column]:
    return lambda kind: kind == i


def _written(spans: Column) -> Column:
    names = F.lit(list(KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def find(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, counts of base spans, `base_sha256`, `spans`, and `n_added`."""
    found = read(docs)
    more = discovered(docs, found)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, _equals(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)
    ]
    empty = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    added = F.coalesce("more", empty)
    return found.join(more, "text_key", "left").select(
        "doc_id", *counts, "base_sha256", _written(F.concat("base", added)).alias("spans"),
        F.size(added).cast("long").alias("n_added"),
    )


def mask_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, last = [], 0
    for a, b, k in sorted((a, -b, k) for k, a, b in spans):
        b = -b
        if a >= last:
            out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = max(last, b)
    return "".join(out) + text[last:]


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "__text"):
            texts_ = batch.column("__text").to_pylist()
            new = []
            for text, more in zip(texts_, batch.column("__more").to_pylist()):
                if text is None:
                    new.append(None)
                    continue
                spans = base_spans(text) + [(s["kind"], s["start"], s["end"]) for s in more or []]
                new.append(mask_text(text, spans) if spans else text)
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n not in ("__text", "__more")]
            names = [n for n in batch.schema.names if n not in ("__text", "__more")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(new, pa.string())], [*names, "__text"])


def masked(docs: DataFrame) -> DataFrame:
    """`docs` with personal data replaced; `n_chars`, if there, is the new length."""
    more = discovered(docs, read(docs)).withColumnRenamed("text_key", "__key").withColumnRenamed("more", "__more")
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    named = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)), F.col("text").alias("__text"))
    rows = named.join(more, F.xxhash64(F.coalesce("__text", F.lit(""))) == F.col("__key"), "left").drop("__key")
    schema = ", ".join(f"{n} {t}" for n, t in named.dtypes)
    out = rows.mapInArrow(frugal(_mask), schema)
    back = {c: F.col(f"c{i}") for i, c in enumerate(others)}
    back |= {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*(back[c].alias(c) for c in docs.columns))
