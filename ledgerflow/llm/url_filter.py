"""URL filter: rules first, then naive Bayes over segmented host and path words.

A rule names a host (with all its subdomains) and the beginning of a path; the longest one that
fits decides. Every other URL is judged by its words: host labels are split into
words by a unigram Viterbi search ("freebets" -> "free bets"), path words are taken as they are, and a
multinomial naive Bayes over hashed words scores them.

The word frequencies come from the visible text of all pages, the class counts from all
URLs that name a seed word (block) or none (allow). Both are Spark aggregates; what is broadcast is
at most ``LEXICON`` words, the most frequent ones, and two numbers for each of ``2**BITS`` word buckets,
whatever the number of pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, pick, ship

#: Words a host can be split into: the most frequent of the pages' text (the bound on what is broadcast).
LEXICON = 50_000
#: A host label has at most 63 characters.
LONGEST_WORD = 63
BITS = 16
#: Added to every bucket's count; small, since URLs hold few words.
SMOOTHING = 0.01
#: Segmentations that a worker keeps, and the longest name among them.
CACHE_ENTRIES, CACHE_LENGTH = 200_000, 256

#: Words that mark an unwanted site, to learn from; each also belongs to the lexicon.
SEED_WORDS = (
    "ads adult banner bet bets betting bonus casino cheap clickbait dating escort farm gambling jackpot loan loans "
    "lottery malware payday phishing pharmacy pills poker porn sex slots spam track tracker tracking viagra warez win xxx"
).split()
#: Frequent words of web addresses, to split off; they carry no verdict by themselves.
WEB_WORDS = "blog cloud co com dev edu en example free gov home info io mail mobile net news online org page shop site store web wiki www".split()

_WORD = re.compile(r"[^\W_]+")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for a null URL or one without ``://``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: from there up to ``?``, ``#`` or the end.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    address = F.coalesce(F.regexp_extract(rest, r"(?s)\A([^?#]*)", 1), F.lit(""))
    host = F.regexp_extract(address, r"(?s)\A([^/]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.substring(address, F.length(host) + 1, F.length(address))


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # "host/path": the host and all its subdomains, paths that begin so

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.rule.partition("/")
        return ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; a block rule wins a tie."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.verdict != "block", r.rule)):
        rule = (F if rule is None else rule).when(r.fits(host, path), r.rule)
        verdict = (F if verdict is None else verdict).when(r.fits(host, path), r.verdict)
    null = F.lit(None).cast("string")
    return (null, null) if rule is None else (rule.otherwise(null), verdict.otherwise(null))


@dataclass
class Lexicon:
    """Unigram word costs (negative log probabilities) and the Viterbi split."""

    cost: dict[str, float]
    unknown: float
    seen: dict[str, list[str]] = field(default_factory=dict)

    @staticmethod
    def of(counts: dict[str, int], extra: tuple[str, ...] | list[str] = ()) -> Lexicon:
        """From word counts; ``extra`` words count at least as an average word."""
        counts = dict(counts)
        usual = max(1, sum(counts.values()) // max(1, len(counts)))
        for w in extra:
            counts[w] = max(counts.get(w, 0), usual)
        total = sum(counts.values())
        return Lexicon({w: -log(n / total) for w, n in counts.items()}, log(total) + 2.0)

    def split(self, label: str) -> list[str]:
        """The most probable words of a name; letters in no word come out as runs."""
        got = self.seen.get(label)
        if got is None:
            got = [w for part in _WORD.findall(label) for w in self._viterbi(part)]
            if len(label) <= CACHE_LENGTH:
                if len(self.seen) >= CACHE_ENTRIES:
                    self.seen.clear()
                self.seen[label] = got
        return got

    def _viterbi(self, name: str) -> list[str]:
        if name.isdigit():
            return [name]
        n = len(name)
        best, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - LONGEST_WORD), end):
                word = name[begin:end]
                c = self.cost.get(word)
                if c is None:
                    if end - begin > 1:
                        continue
                    c = self.unknown  # one letter outside every word
                if best[begin] + c < best[end]:
                    best[end], back[end] = best[begin] + c, begin
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        out: list[str] = []
        loose = None
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):  # neighbouring letters outside every word are one run
            if name[begin:end] not in self.cost:
                loose = begin if loose is None else loose
                continue
            if loose is not None:
                out.append(name[loose:begin])
                loose = None
            out.append(name[begin:end])
        if loose is not None:
            out.append(name[loose:])
        return out


def url_words(lexicon: Lexicon, host: str, path: str) -> list[str]:
    """Words of a URL: the split host labels and the path's words (lower case, numbers as ``#``)."""
    words = [w for label in host.split(".") for w in lexicon.split(label)]
    words += [w for part in _WORD.findall(path.lower()) for w in (["#"] if part.isdigit() else lexicon.split(part))]
    return ["#" if w.isdigit() else w for w in words]


def _bucket(word: str) -> int:
    return crc32(word.encode()) >> (32 - BITS)


@dataclass
class UrlModel:
    lexicon: Lexicon
    weight: np.ndarray  # log odds of block for each word bucket
    prior: float

    def block_odds(self, host: str, path: str) -> float:
        return self.prior + sum(self.weight[_bucket(w)] for w in url_words(self.lexicon, host, path))


def word_counts(texts: DataFrame, col: str, most: int = LEXICON) -> dict[str, int]:
    """The most frequent words (a-z) of the visible text of all pages, at most ``most``.

    Words are taken by classes of frequency (eighths of a power of two), the highest first; of the class
    that does not fit whole, its share of words by hash (a little less than fits). So the driver gets one
    count a class and the words it keeps, and no task sends candidates of its own.
    """
    visible = F.regexp_replace(F.lower(col), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    words = texts.select(F.explode(F.split(visible, "[^a-z]+")).alias("word"))
    counts = words.where(f"length(word) between 2 and {LONGEST_WORD}").groupBy("word").agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("class", F.floor(F.log2("n") * 8)), "words")
    room, whole, share = most, F.lit(True), F.lit(False)
    for r in sorted(counts.groupBy("class").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["class"]):
        if r.words > room:
            part = max(0, room - 4 * room**0.5) / r.words  # the number that a share of the hashes holds varies
            whole = F.col("class") > r["class"]
            share = (F.col("class") == r["class"]) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(part * (1 << 30)))
            break
        room -= r.words
    return {r.word: r.n for r in counts.where(whole | share).collect()}


def train(pages: DataFrame, url_col: str = "url", text_col: str = "html", seeds: tuple[str, ...] | list[str] = tuple(SEED_WORDS)) -> UrlModel:
    """Learn the lexicon from all pages' text, and the class counts from all URLs."""
    spark = pages.sparkSession
    ship(spark)
    rows = pick(pages, url=(url_col, "string"), text=(text_col, "string"))
    lexicon = Lexicon.of(word_counts(rows.where("text is not null"), "text"), [*seeds, *WEB_WORDS])
    shared = spark.sparkContext.broadcast((lexicon, frozenset(seeds)))
    host, path = split_url(F.col("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, bad = shared.value
        total = np.zeros((2, 1 << BITS), np.int64)
        urls = np.zeros(2, np.int64)
        for batch in batches:
            for h, p, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = url_words(lex, h, p)
                label = int(not bad.isdisjoint(words))
                urls[label] += n
                for w in words:
                    total[label, _bucket(w)] += n
        for label in (0, 1):
            at = np.flatnonzero(total[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at) + 1, label)), pa.array(np.append(at, -1)), pa.array(np.append(total[label][at], urls[label]))],
                names=["label", "bucket", "n"],
            )

    urls = rows.select(host.alias("host"), path.alias("path")).where("host <> ''").withColumn("n", F.lit(1).cast("long"))
    sums = urls.mapInArrow(run, "label long, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect()
    counts, pages_of = np.full((2, 1 << BITS), SMOOTHING), np.ones(2)
    for r in sums:
        if r.bucket < 0:
            pages_of[r.label] += r.n
        else:
            counts[r.label, r.bucket] += r.n
    p = np.log(counts / counts.sum(1, keepdims=True))
    known = (counts > SMOOTHING).any(axis=0)  # a word that no URL had says nothing
    return UrlModel(lexicon, np.where(known, p[1] - p[0], 0.0), float(np.log(pages_of[1] / pages_of[0])))


def judge(pages: DataFrame, model: UrlModel, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (log odds of the method) of every row.

    Defined cases: a null URL, or one without ``://``, has an empty host and path and is allowed, with
    null odds; repeated rows and null ids come out as they went in; extra columns are ignored;
    host labels and path words are segmented whole, whatever their length.
    """
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    host, path = split_url(F.col("url"))
    rows = pick(pages, page_id=(id_col, "long"), url=(url_col, "string")).select("page_id", host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            odds = [m.block_odds(h, p) if h or p else None for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds, pa.float64())], names=["page_id", "host", "path", "block_odds"])

    scored = rows.mapInArrow(run, "page_id long, host string, path string, block_odds double")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("block_odds") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "block_odds")
