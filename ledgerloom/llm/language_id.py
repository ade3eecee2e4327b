"""Language identification by fusing evidence of text, markup, address and host.

A page's posterior is proportional to the product of

* the likelihood of its text, from byte n-grams of documents of known language, tempered by a power, since
  neighbouring n-grams are not independent;
* the likelihood of the language its markup declares and of its address's suffix, given the language;
* the prior of its host, smoothed towards its registered domain's, and that towards all pages'.

The last three come from grouped counts of the languages that the texts alone suggest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm._frames import Workspace
from ledgerloom.llm._words import as_bytes

BITS = 15  # of the bucket of an n-gram
NGRAM = 4
SMOOTHING = 0.5
TEMPER = 0.2  # power of the text's likelihood
PRIOR_WEIGHT = 4.0  # pages that a wider prior counts as
EVIDENCE_WEIGHT = 1.0  # added to every count of declared languages and suffixes
MAX_LANGUAGES = 500  # rows of the model times buckets stay within what is broadcast

_CLOSING = {name: re.compile(rb"</" + name + rb"\s*+>") for name in (b"script", b"style")}
_HIDDEN = re.compile(rb"<(script|style)(?![0-9a-z_\x80-\xff])")
_PAGE = re.compile(rb"<html(?![0-9a-z_\x80-\xff])")
_LANG = re.compile(rb"\blang\s*+=\s*+(?:[\"']\s*+)?([a-z]+)")
_NUMBER = re.compile(r"&#([0-9]{9,})")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def page_text(markup: str) -> str:
    """Text of a page without markup, scripts, styles and comments, in one pass forward.

    A closing mark that is missing once is missing for all that follows, so no part is searched twice; what
    opens without an end is text from the last ``<`` that has one on.
    """
    raw = markup.encode("utf-8", "replace")
    low, parts, at, missing = raw.lower(), [], 0, set()
    while (start := raw.find(b"<", at)) >= 0:
        end = -1
        if hidden := _HIDDEN.match(low, start):
            if hidden[1] not in missing:
                closing = _CLOSING[hidden[1]].search(low, hidden.end())
                end = closing.end() if closing else -1
                missing.update(() if closing else (hidden[1],))
        elif raw.startswith(b"<!--", start) and b"--" not in missing:
            end = raw.find(b"-->", start + 4) + 3
            if end < 3:
                end = -1
                missing.add(b"--")
        if end < 0:
            end = raw.find(b">", start + 1) + 1
        if end <= 0:
            break
        parts.append(raw[at:start])
        at = end
    parts.append(raw[at:])
    # digits beyond those of the last code point say no more, and Python refuses to read thousands of them
    return html.unescape(_NUMBER.sub(lambda found: "&#0" + found[1].lstrip("0")[:8], b" ".join(parts).decode("utf-8", "replace")))


def declared_language(markup: str) -> str | None:
    """Primary language that the page's first ``<html>`` declares."""
    low = markup.encode("utf-8", "replace").lower()
    if not (tag := _PAGE.search(low)):
        return None
    end = low.find(b">", tag.end())
    found = _LANG.search(low, tag.end(), end if end >= 0 else len(low))
    return found[1].decode() if found else None


def address_of(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, registered domain (the last two labels) and suffix (the last) of an address; all null if it has no host."""
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    if not host:
        return None, None, None
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


_KEPT = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _plain(text: bytes) -> bytes:
    return b" ".join(text.translate(_KEPT).split())


def ngram_buckets(text: bytes) -> np.ndarray:
    """Buckets of all byte n-grams of the lower-cased text, digits and punctuation as blanks."""
    codes = np.frombuffer(b" " + _plain(text) + b" ", np.uint8).astype(np.uint64)
    total = np.zeros(max(0, len(codes) - NGRAM + 1), np.uint64)
    for at in range(NGRAM):
        total = total * np.uint64(257) + codes[at:at + len(total)]
    return (total * _ODD >> np.uint64(64 - BITS)).astype(np.int64)


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log probability of every bucket per language, from all documents with a language."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
                table = counts.setdefault(lang, np.zeros(1 << BITS, np.int64))
                table += np.bincount(ngram_buckets(text), minlength=1 << BITS)
        for lang, table in counts.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(table[used])],
                                             ["lang", "bucket", "n"])
    rows = docs.where("lang is not null").select("lang", "text").mapInArrow(counted, "lang string, bucket int, n bigint")
    languages = sorted(row["lang"] for row in docs.where("lang is not null").select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), 1 << BITS))
    places = {lang: at for at, lang in enumerate(languages)}
    counts[[places[lang] for lang in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    counts += SMOOTHING
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts


EVIDENCE = ("page_id bigint, host string, domain string, suffix string, declared string, best int, scores array<double>")


def page_evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """What each page says about its language: address parts, declared language, tempered log likelihood per language.

    ``best`` is the place of the likeliest language, the first of equals; null for a page without text.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, markup in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found = ngram_buckets(page_text(markup or "").encode("utf-8", "replace"))
                scores = TEMPER * shared.value[:, found].sum(axis=1)
                blank = len(found) <= 1
                rows.append((*address_of(url), declared_language(markup or ""),
                             None if blank or not len(scores) else int(scores.argmax()), [0.0] * len(scores) if blank else scores.tolist()))
            kinds = [pa.string()] * 4 + [pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), *(pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds))],
                ["page_id", "host", "domain", "suffix", "declared", "best", "scores"])
    return pages.select("page_id", "url", "html").mapInArrow(over, EVIDENCE)


def _votes(rows: DataFrame, key: str, count: int) -> DataFrame:
    """Per key the number of pages of each language, as an array."""
    sums = [F.count_if(F.col("best") == at).cast("double") for at in range(count)]
    return rows.where(f"{key} is not null and best is not null").groupBy(key).agg(F.array(*sums).alias(f"{key}_votes"))


def language_posteriors(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Every page's likeliest language: ``page_id, lang, probability, text_lang, declared, suffix, host``.

    ``pages`` has ``page_id, url, html``; ``docs`` has ``text`` and ``lang`` and trains the text model. Ties go to the
    language first in order. A page without text, markup or address is judged by what is left; with
    nothing, by the languages of all pages. ``text_lang`` is null without text. Rows that repeat an id are judged one by one.
    Pages are read whole, however long, in time that grows with their length; other columns are ignored.
    Without documents of known language ``lang`` and ``probability`` are null. An empty table gives no rows.
    """
    work = Workspace(pages.sparkSession, "languages")
    languages, model = text_model(docs)
    if not languages:
        none = page_evidence(pages, [], np.zeros((0, 1 << BITS)))
        return none.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "suffix", "host")
    rows = work.stage(page_evidence(pages, languages, model), "evidence")
    count = len(languages)
    total = rows.agg(*(F.count_if(F.col("best") == at).alias(f"n{at}") for at in range(count))).first()
    pages_of = [float(total[at]) for at in range(count)]
    everywhere = [(n + 1) / (sum(pages_of) + count) for n in pages_of]
    for key in ("host", "domain", "declared", "suffix"):
        rows = rows.join(_votes(rows, key, count), key, "left")

    def own(at: int) -> Column:
        return F.when(F.col("best") == at, 1.0).otherwise(0.0)

    def votes(key: str, at: int) -> Column:
        """Pages of a language with this key, without the page itself."""
        return F.coalesce(F.col(f"{key}_votes")[at] - own(at), F.lit(0.0))

    def share(key: str, at: int, wider: Column) -> Column:
        others = sum((votes(key, other) for other in range(1, count)), votes(key, 0))
        return (votes(key, at) + PRIOR_WEIGHT * wider) / (others + PRIOR_WEIGHT)

    def log_evidence(key: str, at: int) -> Column:
        """Log likelihood of the value given the language, against other values; 0 for a page without one."""
        given = (votes(key, at) + EVIDENCE_WEIGHT) / (F.lit(pages_of[at]) - own(at) + 2 * EVIDENCE_WEIGHT)
        return F.when(F.col(key).isNull(), 0.0).otherwise(F.log(given))

    scores = [F.col("scores")[at] + log_evidence("declared", at) + log_evidence("suffix", at)
              + F.log(share("host", at, share("domain", at, F.lit(everywhere[at])))) for at in range(count)]
    choices = [F.struct(score.alias("score"), F.lit(-at).alias("order"), F.lit(lang).alias("lang"))
               for at, (score, lang) in enumerate(zip(scores, languages, strict=True))]
    judged = rows.withColumn("choices", F.array(*choices)).withColumn("top", F.array_max("choices"))
    names = F.array(*map(F.lit, languages))
    weight = F.aggregate("choices", F.lit(0.0), lambda total, choice: total + F.exp(choice["score"] - F.col("top.score")))
    return judged.select("page_id", F.col("top.lang").alias("lang"),
                         (1 / weight).alias("probability"), F.get(names, F.col("best")).alias("text_lang"), "declared", "suffix", "host")
