"""Document fingerprints: a Merkle tree over sections and paragraphs.

Sections are parted by blank lines, paragraphs are lines, and a paragraph's
leaves are its sentences (longer ones are cut after words that a hash picks, so
cuts depend on the content at hand). All of the text, separators included, is in
some leaf; a node's digest is the digest of its children's, so two texts are
equal if and only if their roots are (128 bits), and subtrees of equal digest
can be skipped when two trees are held against each other.

A fingerprint is written as ``root;section|section``, a section as
``paragraph/paragraph``, a paragraph as ``leaf.leaf``, a leaf as six hex digits
of its digest and its length in code points.

To put each document next to its successor in id order, without a single
ordered task, ids are cut into ranges at quantiles; a range gets a copy of the
first document of the range after it. Each text is shuffled once.

Nulls and edges: a null text is the empty text; null ids come last; rows that
repeat an id follow each other in the order of a hash of their text; the
document after the last is the first (a single document follows itself); equal
fingerprints have likeness 1; an empty table gives an empty result. Rows of one
id are ordered in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, batch_rows, small_batches

LEAST = -(1 << 63)
SECTION = re.compile(r"\n[ \t\r]*\n\s*")
SENTENCE = re.compile(r"[^.!?]*(?:[.!?]+[^\w.!?]*|$)")
WORD = re.compile(r"\S*\s*")
SHORT, LONG, MARK = 48, 96, 6
picks = xxhash.xxh3_64_intdigest

Tree = list[list[list[tuple[str, int]]]]
RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def digest(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def cut(text: str, at: Iterator[int]) -> list[str]:
    out, start = [], 0
    for end in at:
        if end > start:
            out.append(text[start:end])
            start = end
    if start < len(text):
        out.append(text[start:])
    return out


def runs_of_words(sentence: str) -> Iterator[int]:
    """Ends of leaves: after words that a hash picks, LONG code points at most."""
    start = end = 0
    for word in WORD.findall(sentence):
        while end + len(word) - start > LONG:
            if end == start:                       # a word longer than a leaf
                start = end = end + LONG
                word = word[LONG:]
            else:
                start = end
            yield end
        end += len(word)
        if picks(word) % 6 == 0:
            yield end
            start = end


def leaves(paragraph: str) -> list[str]:
    out = []
    for s in cut(paragraph, (m.end() for m in SENTENCE.finditer(paragraph))):
        if len(s) <= SHORT:
            out.append(s)
        else:
            out += cut(s, runs_of_words(s))
    return out


def fingerprint(text: str) -> str:
    """The written Merkle tree of ``text``."""
    sections, digests = [], []
    for section in cut(text, (m.end() for m in SECTION.finditer(text))):
        paragraphs, below = [], []
        for paragraph in section.splitlines(keepends=True):
            parts = leaves(paragraph)
            marks = [digest(p.encode("utf-8", "surrogatepass")) for p in parts]
            below.append(digest(b"".join(marks)))
            paragraphs.append(".".join(f"{m.hex()[:MARK]}{len(p)}" for m, p in zip(marks, parts, strict=True)))
        digests.append(digest(b"".join(below)))
        sections.append("/".join(paragraphs))
    return f"{digest(b''.join(digests)).hex()};{'|'.join(sections)}"


def read(written: str) -> tuple[str, Tree]:
    """Root and sections of paragraphs of (leaf digest, length)."""
    root, _, rest = written.partition(";")
    return root, [[[(x[:MARK], int(x[MARK:])) for x in p.split(".")] for p in s.split("/")] for s in rest.split("|")] if rest else []


def likeness(one: str, other: str) -> float:
    """Share of the two texts that lies in leaves they have in common, 0 to 1."""
    if one[:32] == other[:32]:
        return 1.0
    bags = []
    for written in (one, other):
        rest = written[33:]
        bags.append(Counter(re.split(r"[./|]", rest)) if rest else Counter())
    weigh = lambda bag: sum(int(leaf[MARK:]) * n for leaf, n in bag.items())
    whole = weigh(bags[0]) + weigh(bags[1])
    return 2.0 * weigh(bags[0] & bags[1]) / whole if whole else 1.0


def differing(one: str, other: str) -> list[tuple[int, int]]:
    """Spans (code points, in the first text) of the leaves that the other tree
    does not have. Branches found whole in the other tree are skipped."""
    if one[:32] == other[:32]:
        return []
    tree, against = read(one)[1], read(other)[1]
    whole = {str(s) for s in against}, {str(p) for s in against for p in s}, {x for s in against for p in s for x in p}
    size = lambda p: sum(n for _, n in p)
    spans, at = [], 0

    def add(n: int) -> None:
        if spans and spans[-1][1] == at:
            spans[-1] = (spans[-1][0], at + n)
        else:
            spans.append((at, at + n))

    for section in tree:
        if str(section) in whole[0]:
            at += sum(map(size, section))
            continue
        for paragraph in section:
            if str(paragraph) in whole[1]:
                at += size(paragraph)
                continue
            for leaf in paragraph:
                if leaf not in whole[2]:
                    add(leaf[1])
                at += leaf[1]
    return spans


def edited(text: str, after: str) -> str:
    """``text`` with its last third (rounded down) replaced by as many first
    code points of ``after``."""
    k = len(text) // 3
    return text[:len(text) - k] + after[:k]


def ranges(docs: DataFrame, parts: int) -> tuple[np.ndarray, dict[int, int]]:
    """Ascending cuts between ranges, and each non-empty range's greatest key.
    Both are as many as there are ranges, not rows."""
    keys = docs.select("key")
    cuts = keys.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] if parts > 1 else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    def run(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows:
                key = b.column("key").to_numpy()
                part = np.searchsorted(cuts, key, side="right")
                held = np.unique(part)
                top = np.full(len(cuts) + 1, LEAST)
                np.maximum.at(top, part, key)
                yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(top[held])], names=["part", "top"])
    with batch_rows(docs.sparkSession, THIN_ROWS):
        tops = keys.mapInArrow(run, "part int, top long").groupBy("part").agg(F.max("top").alias("top")).collect()
    return cuts, {r["part"]: r["top"] for r in tops}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` of every row. The
    next document is the one before it in id order."""
    parts = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))
    cuts, tops = ranges(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("key")), parts)
    order = sorted(tops, reverse=True)
    # The range whose last document is followed by the first of this range.
    before = {tops[p]: order[i - 1] for i, p in enumerate(order)}
    starts = np.array(sorted(before), np.int64)

    def deal(batches: Batches) -> Batches:
        for b in batches:
            key = b.column("key").to_numpy()
            part = np.searchsorted(cuts, key, side="right").astype(np.int32)
            names = ["part", "follows", *b.schema.names]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(key), bool)), *b.columns], names=names)
            lead = np.flatnonzero(np.isin(key, starts))
            if len(lead):
                copies = b.take(pa.array(lead))
                to = np.array([before[k] for k in key[lead].tolist()], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.ones(len(lead), bool)), *copies.columns], names=names)

    dealt = (rows.mapInArrow(deal, "part int, follows boolean, key long, doc_id long, th long, text string")
             .repartition("part").sortWithinPartitions("part", "follows", F.desc("key"), "th"))

    def run(batches: Batches) -> Batches:
        held = None                                        # the row before: part, id, text, fingerprint
        for b in batches:
            out = []
            for part, follows, doc_id, body in zip(*(b.column(c).to_pylist() for c in ("part", "follows", "doc_id", "text")), strict=True):
                if held is None and follows:
                    continue                               # a repeat of the following document
                own = fingerprint(body)
                if held is not None:
                    _, its_id, its_text, its_print = held
                    new = edited(its_text, body)
                    new_print = fingerprint(new)
                    out.append((its_id, len(its_text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                                its_print, new_print, likeness(its_print, new_print), likeness(its_print, own)))
                held = None if follows else (part, doc_id, body, own)
            yield batch_of(RESULT, zip(*out, strict=True) if out else [[]] * len(RESULT))

    return dealt.mapInArrow(run, ", ".join(f"{f.name} {t}" for f, t in zip(
        RESULT, ("long", "long", "string", "string", "string", "double", "double"), strict=True)))
