"""Line deduplication by a tree of line templates.

A line falls, by its number of tokens and its leading tokens, into a leaf of a tree of fixed depth; tokens with
digits count as variable there. Within a leaf a token is fixed at its place if enough documents have it there, and
variable otherwise, whatever the order in which lines come. A line's template is its fixed tokens with a mark in the
variable places; with too few fixed tokens it has none. Templates of enough documents recur and their lines are dropped.
A line with more digits than a template allows recurs if enough documents have it word for word, digits included.
A long line recurs in fewer documents, as chance does not repeat it.

Copies of one document share their lines without saying anything about them, so documents count by family: texts that
are alike, or that share 60 of 100 of their five-word shingles, are of one family, and so is what they have in common with others.
Where few families hold a line, those that share a quarter of the rest of their texts count as one, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._bits import key_filter, may_hold
from ledgerloom.llm._frames import Workspace, components
from ledgerloom.llm._words import as_bytes, shingle_sets

LEADING = 2  # tokens of the path to a leaf
MIN_DOCUMENTS = 10
MIN_FIXED = 0.6  # part of a line's tokens that a template must fix
VARIABLE = "<*>"
MARK = VARIABLE.encode()
LONG = ((20, 2), (10, 5))  # a line of so many tokens word for word recurs in so many unrelated documents
SKETCH = 64  # least shingle hashes that stand for the rest of a document
COPY = 0.25  # documents whose rests share that part of their shingles are near copies; unrelated ones mostly share under 0.1
PART_BITS = 6
HASHES, BANDS = 1 << PART_BITS, 16  # least values that stand for a text's shingles; bands of which one must agree to compare two texts
FAMILY = 0.6  # texts with that part of their shingles in common are of one family
MIN_WORDS = 5  # texts of fewer words have no shingle and are families of their own
_DIGIT = re.compile(rb"[0-9]")

BLANK = r" \t\n\x0B\f\r"  # in a character class

LINES = "leaf bigint, line bigint, doc bigint, least int"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masked(line: bytes) -> list[bytes]:
    """Tokens of a line, those with digits as variable."""
    tokens = line.split()
    return [MARK if _DIGIT.search(token) else token for token in tokens] if _DIGIT.search(line) else tokens


def leaf_of(tokens: list[bytes]) -> int:
    return _signed(xxhash.xxh3_64_intdigest(b"\0".join((str(len(tokens)).encode(), *tokens[:LEADING]))))


def line_hash(tokens: list[bytes]) -> int:
    return _signed(xxhash.xxh3_64_intdigest(b" ".join(tokens)))


def exact_hash(tokens: list[bytes]) -> int:
    """Hash of a line word for word; apart from those of masked lines and leaves."""
    return _signed(xxhash.xxh3_64_intdigest(b"\0exact\0" + b" ".join(tokens)))


def needed(size: int, least: int) -> int:
    """Documents in which a line recurs that is the same in ``size`` tokens."""
    return min(least, next((count for tokens, count in LONG if size >= tokens), least))


def repeats_of(line: bytes, tokens: list[bytes], least: int, fixed: float) -> Iterator[tuple[int, int, int]]:
    """Key, hash and least documents of a line as it is and with its digits masked, where templates of ``least`` do not decide."""
    same = len(tokens) - tokens.count(MARK)
    general, whole = needed(same, least), needed(len(tokens), least)
    if same < fixed * len(tokens):
        general = None
    elif general < least:
        yield exact_hash([b"", *tokens]), line_hash(tokens), general
    if same < len(tokens) and (general is None or whole < general):
        key = exact_hash(line.split())
        yield key, key, whole


def _lines(docs: DataFrame, least: int, fixed: float) -> DataFrame:
    """Leaf and hash of every different masked line of a document.

    What can recur without a template has rows of its own besides, with a key as leaf and its least number of documents.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, line, count, sizes = [], [], [], []
            for text in as_bytes(batch.column("text")):
                seen, own = {}, set()
                for raw in set(text.split(b"\n")):
                    if tokens := masked(raw):
                        seen[line_hash(tokens)] = tokens
                        own.update(repeats_of(raw, tokens, least, fixed))
                leaf += [leaf_of(tokens) for tokens in seen.values()]
                line += seen
                count += [None] * len(seen)
                for key, value, needs in own:
                    leaf.append(key)
                    line.append(value)
                    count.append(needs)
                sizes.append(len(seen) + len(own))
            doc = np.repeat(batch.column("doc").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(doc), pa.array(count, pa.int32())],
                                             ["leaf", "line", "doc", "least"])
    return docs.select("doc", "text").mapInArrow(over, LINES)


def _wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc, text`` of documents among which are all that ``wanted`` names; few others come with them."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.select("doc"), "doc"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, batch.column("doc").to_numpy())))
    return docs.select("doc", "text").mapInArrow(over, "doc bigint, text string")


def _masked_texts(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """``leaf, line, masked`` of the masked lines in ``kinds``, each read from the one document ``doc`` named there."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lines in zip(as_bytes(batch.column("text")), batch.column("lines").to_pylist(), strict=True):
                wanted = set(lines)
                for line in set(text.split(b"\n")):
                    if (tokens := masked(line)) and (found := line_hash(tokens)) in wanted:
                        wanted.discard(found)
                        rows.append((leaf_of(tokens), found, b" ".join(tokens).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in
                                              enumerate([pa.int64(), pa.int64(), pa.string()])], ["leaf", "line", "masked"])
    lines = kinds.groupBy("doc").agg(F.collect_set("line").alias("lines"))
    found = _wanted(docs, kinds).join(lines.hint("merge"), "doc").mapInArrow(over, "leaf bigint, line bigint, masked string")
    return found.groupBy("leaf", "line").agg(F.any_value("masked").alias("masked"))  # rows alike in id and text give a line each


# The order in which an empty part borrows from others.
_LENDERS = np.stack([np.random.default_rng([20240607, place]).permutation(HASHES) for place in range(HASHES)])
_BOUNDS = np.arange(HASHES, dtype=np.uint64) << np.uint64(64 - PART_BITS)


def signature(values: np.ndarray) -> bytes:
    """The least of a text's sorted shingles in each of HASHES parts of their range, 32 bits each.

    A part without one borrows from the first part that has one, in an order of its own, so two texts agree in a
    place with the probability of what they share, also where they have few shingles.
    """
    first = np.searchsorted(values, _BOUNDS)
    filled = np.diff(first, append=len(values)) > 0
    lender = np.take_along_axis(_LENDERS, filled[_LENDERS].argmax(axis=1)[:, None], axis=1)[:, 0]
    source = np.where(filled, np.arange(HASHES), lender)
    return (values[first[source]] << np.uint64(PART_BITS) >> np.uint64(32)).astype(np.uint32).tobytes()


def _signatures(docs: DataFrame) -> DataFrame:
    """``node, signature`` of every row with MIN_WORDS words."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            wordy = [len(text.split(None, MIN_WORDS)) >= MIN_WORDS for text in texts]
            found = [signature(values) if enough else None for values, enough in zip(shingle_sets(texts), wordy, strict=True)]
            rows = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "signature"])
            yield rows.filter(pa.array(wordy, pa.bool_()))
    return docs.select("node", "text").mapInArrow(over, "node bigint, signature binary")


def _agreeing(pairs: DataFrame) -> DataFrame:
    """``a, b`` of the pairs of nodes whose signatures agree in FAMILY of their places."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(-1, HASHES) for name in ("left", "right"))
            alike = np.equal(*both).mean(axis=1) >= FAMILY
            yield batch.select(["a", "b"]).filter(pa.array(alike))
    return pairs.select("a", "b", "left", "right").mapInArrow(over, "a bigint, b bigint")


def families(work: Workspace, docs: DataFrame) -> DataFrame:
    """``doc, family`` of documents with ``doc`` and ``text``: exact copies, and texts linked by signatures that agree.

    In every bucket of a band only the links to the bucket's first text are looked at, so no bucket's pairs are listed.
    """
    rows = docs.select("doc", "text", F.xxhash64("text").alias("node"))
    named = work.stage(_signatures(rows).groupBy("node").agg(F.any_value("signature").alias("signature")), "signatures")
    width = 4 * HASHES // BANDS
    bands = F.explode(F.array(*(F.xxhash64(F.lit(band), F.substring("signature", 1 + band * width, width)) for band in range(BANDS))))
    buckets = named.select("node", bands.alias("bucket"))
    first = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("bucket", "a")
    pairs = buckets.join(first, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    pairs = (pairs.join(named.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a")
             .join(named.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b"))
    labels = components(work, _agreeing(pairs))
    # texts of few words stay one by one
    own = F.when(F.col("text").rlike(rf"\A[{BLANK}]*+(?:[^{BLANK}]++[{BLANK}]++){{{MIN_WORDS - 1}}}[^{BLANK}]"), F.col("node"))
    rows = rows.select("doc", own.alias("node"))
    return work.stage(rows.join(labels, "node", "left").select("doc", F.coalesce("label", "node", "doc").alias("family")).distinct(), "families")


def _rest_sketches(docs: DataFrame, held: DataFrame, least: int, fixed: float) -> DataFrame:
    """``leaf, line, least, doc, sketch`` of the lines that ``held`` (``leaf, doc``) names; the sketch is that of the text without the line."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = as_bytes(batch.column("text"))
            for doc, text, keys, values in zip(batch.column("doc").to_pylist(), texts, batch.column("keys").to_pylist(),
                                               shingle_sets(texts), strict=True):
                wanted, forms = set(keys), {}
                for line in set(text.split(b"\n")):
                    if tokens := masked(line):
                        for form in repeats_of(line, tokens, least, fixed):
                            if form[0] in wanted:
                                forms.setdefault(form, []).append(line)
                for form, lines in forms.items():
                    inside = np.concatenate(list(shingle_sets(lines)))
                    rest = values[:SKETCH + len(inside)]
                    rows.append((*form, doc, rest[~np.isin(rest, inside)][:SKETCH].view(np.int64)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)],
                                             ["leaf", "line", "least", "doc", "sketch"])
    keys = held.groupBy("doc").agg(F.collect_set("leaf").alias("keys"))
    # a merge join whatever the size, as the last one
    return _wanted(docs, held).join(keys.hint("merge"), "doc").mapInArrow(
        over, "leaf bigint, line bigint, least int, doc bigint, sketch array<bigint>")


def unrelated(sketches: list[np.ndarray]) -> int:
    """Groups of documents by their sketches, near copies and copies of those in one."""
    groups: list[list[np.ndarray]] = []
    for own in sketches:
        near = [group for group in groups if any(alike(own, other) for other in group)]
        groups = [group for group in groups if all(group is not other for other in near)] + [[own, *(item for group in near for item in group)]]
    return len(groups)


def alike(left: np.ndarray, right: np.ndarray) -> bool:
    both = np.union1d(left, right)[:SKETCH]
    return np.isin(np.intersect1d(left, right), both).sum() >= COPY * len(both)


def _unrelated_repeats(work: Workspace, docs: DataFrame, held: DataFrame, least: int, fixed: float) -> DataFrame:
    """``leaf, line, doc`` of the rows in ``held`` (``leaf, line, doc, least, family``) whose line enough unrelated documents have."""
    counts = held.select("leaf", "family").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    held = work.stage(held.join(counts, "leaf").where("n >= least"), "repeats")
    # as many families as a template needs count as they are
    many, few = held.where(F.col("n") >= least), held.where(F.col("n") < least)
    # one document stands for its family, so no line has as many sketches as a template needs documents
    holders = few.groupBy("leaf", "family").agg(F.min("doc").alias("doc")).select("leaf", "doc")
    sketches = work.stage(_rest_sketches(docs, holders, least, fixed), "sketches")
    groups = sketches.groupBy("leaf", "least").agg(F.collect_list("sketch").alias("sketches"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recurs = [unrelated([np.array(item, np.int64).view(np.uint64) for item in sketches]) >= count for sketches, count
                      in zip(batch.column("sketches").to_pylist(), batch.column("least").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("leaf").filter(pa.array(recurs, pa.bool_()))], ["leaf"])
    recurring = groups.mapInArrow(judged, "leaf bigint")
    return many.select("leaf", "line", "doc").unionByName(few.join(recurring, "leaf", "left_semi").select("leaf", "line", "doc"))


def recurring_lines(work: Workspace, docs: DataFrame, least: int = MIN_DOCUMENTS, fixed: float = MIN_FIXED) -> DataFrame:
    """``leaf, line, doc`` of the lines that recur, by template or word for word, for documents with ``doc`` and ``text``."""
    # no more families than documents, so what too few documents hold is out
    found = work.stage(_lines(docs, least, fixed), "lines")
    counts = (found.select("leaf", "doc", "least").distinct().groupBy("leaf")
              .agg(F.count(F.lit(1)).alias("n"), F.any_value("least").alias("least")))
    leaves = work.stage(counts.where(F.col("n") >= F.coalesce("least", F.lit(least))).select("leaf"), "leaves")
    held = work.stage(found.join(leaves, "leaf", "left_semi").withColumn("whole", F.col("least").isNull())
                      .join(families(work, docs), "doc"), "held")
    repeats = _unrelated_repeats(work, docs, held.where("not whole").drop("whole"), least, fixed)
    lines = held.where("whole")
    # hot lines count as one row from here on
    kinds = work.stage(lines.groupBy("leaf", "line", "family").agg(F.min("doc").alias("doc")).groupBy("leaf", "line").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc")), "kinds")
    kinds = work.stage(kinds.join(_masked_texts(docs, kinds), ["leaf", "line"]), "texts")
    places = kinds.select("leaf", "line", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    support = places.groupBy("leaf", "at", "token").agg(F.sum("n").alias("support"))
    token = F.when((F.col("support") >= least) & (F.col("token") != VARIABLE), F.col("token"))
    marked = (places.join(support, ["leaf", "at", "token"])
              .groupBy("leaf", "line").agg(F.sort_array(F.collect_list(F.struct("at", token.alias("token")))).alias("tokens")))
    tokens = F.transform("tokens", lambda item: F.coalesce(item["token"], F.lit(VARIABLE)))
    known = F.size(F.filter("tokens", lambda item: item["token"].isNotNull()))
    templates = (marked.where(known >= fixed * F.size("tokens"))
                 .select("leaf", "line", F.xxhash64("leaf", F.array_join(tokens, " ")).alias("template")))
    templates = work.stage(templates, "templates")
    members = lines.select("leaf", "line", "doc", "family").join(templates, ["leaf", "line"])
    recurring = (members.select("template", "family").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") >= least).select("template"))
    return members.join(recurring, "template", "left_semi").select("leaf", "line", "doc").unionByName(repeats)


def without_recurring_lines(docs: DataFrame, least: int = MIN_DOCUMENTS, fixed: float = MIN_FIXED) -> DataFrame:
    """Every document without the lines that recur: ``doc_id, n_lines, n_dropped, text``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. ``n_lines`` counts lines with a token; blank lines stay. A
    null text stays null with 0 lines. Rows alike in id and text count as one document; other rows that repeat an id are
    documents of their own. Copies and near copies of a text of five words and more count as one document however many they are, so they
    keep lines that only they share. Texts are read whole, however long. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "lines")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("doc"))
    drops = work.stage(recurring_lines(work, rows, least, fixed).groupBy("doc").agg(F.collect_set("line").alias("lines")), "drops")

    def stripped(batch: pa.RecordBatch, drop: list) -> pa.RecordBatch:
        found = []
        texts = [value if value is None else value.encode("utf-8", "surrogatepass") for value in batch.column("text").to_pylist()]
        for text, dropped in zip(texts, drop, strict=True):
            if not text or not dropped:
                found.append((sum(not line.isspace() for line in filter(None, (text or b"").split(b"\n"))), 0,
                              None if text is None else text.decode("utf-8", "replace")))
                continue
            gone, kept, count = set(dropped), [], 0
            lines = text.split(b"\n")
            for line in lines:
                tokens = masked(line)
                count += bool(tokens)
                if not tokens or line_hash(tokens) not in gone and (MARK not in tokens or exact_hash(line.split()) not in gone):
                    kept.append(line)
            found.append((count, len(lines) - len(kept), b"\n".join(kept).decode("utf-8", "replace")))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([row[0] for row in found], pa.int64()), pa.array([row[1] for row in found], pa.int64()),
             pa.array([row[2] for row in found], pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])

    # only documents that may lose a line meet their drops; those the filter lacks lose none and are not shuffled
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(drops.select("doc"), "doc"))

    # tested on the key alone, so a text goes to Python once, on the side where it is stripped
    @F.pandas_udf("boolean")
    def held(doc: pd.Series) -> pd.Series:
        return pd.Series(may_hold(shared.value, doc.to_numpy(np.int64)), index=doc.index)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield stripped(batch, batch.column("lines").to_pylist())

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield stripped(batch, [None] * batch.num_rows)
    schema = "doc_id bigint, n_lines bigint, n_dropped bigint, text string"
    rows = rows.select("doc_id", "text", "doc")
    maybe = rows.where(held("doc"))
    # a merge join whatever the size: what is dropped grows with the documents
    return maybe.join(drops.hint("merge"), "doc", "left").select("doc_id", "text", "lines").mapInArrow(over, schema).unionByName(
        rows.where(~held("doc")).select("doc_id", "text").mapInArrow(alone, schema))
