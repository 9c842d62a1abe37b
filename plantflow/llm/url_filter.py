"""URL filter with Bloom-filter cascades, all in DataFrame functions.

A rule names a host and a path, `example.net/en/`, and fits a URL whose host is the rule's or a subdomain of
it and whose path begins with the rule's. So a URL can only be fitted by rules among its *keys*: every
suffix of its host, joined with its path's beginnings of the lengths that rules have. The keys of all URLs
of the corpus are the key universe.

For each verdict a cascade says which keys are listed. Level 1 is a Bloom filter of the listed keys; level 2
one of the unlisted keys of the universe that level 1 lets through; level 3 one of the listed keys that
level 2 lets through; and so on, until a level lets nothing wrong through. A key is listed if the first
level that denies it is an even one. Because every key that will be asked is in the universe, that is exact.
Level 1 is made so sparse that what it lets through wrongly is about as much as is listed, so all levels
together take about log2(universe / listed) bits for each listed key, however large the corpus is; more than
`MAX_BITS` in one level is refused. The filters are arrays of longs in the plan: no join, no Python.

The longest fitting rule wins (by the length of host and path together; of equally long ones the last by its
text). Without a fitting rule the verdict is `allow`: the cascades have denied all keys of the URL.

Edge cases: a null URL, or one without `://`, has an empty host and path, no keys and no rule; repeated rows
each get a row; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from plantflow.session import durable

MAX_BITS = 1 << 26  # 8 MB


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]

    def passes(self, key: Column, number: int) -> Column:
        """Whether the filter lets a key through."""
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<long>")  # folded to a constant

        def is_set(place: Column) -> Column:
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            return F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1

        return F.forall(_places(key, number, self.bits, self.hashes), is_set)


def _places(key: Column, number: int, bits: int, hashes: int) -> Column:
    """Bit places of a key at a level, by double hashing."""
    first = F.pmod(F.xxhash64(F.lit(2 * number), key), F.lit(bits))
    step = F.pmod(F.xxhash64(F.lit(2 * number + 1), key), F.lit(bits))
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(first + step * i, F.lit(bits)))


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, letters, letters.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every suffix of the host with every beginning of the path of a rule's length."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    beginnings = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    beginnings = F.array_compact(beginnings)
    return F.flatten(F.transform(suffixes, lambda s: F.transform(beginnings, lambda p: F.concat(s, p))))


def _level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A Bloom filter of the keys; only its words reach the driver."""
    bits = max(64, ceil(count * log(1 / rate) / log(2) ** 2 / 64) * 64)
    if bits > MAX_BITS:
        raise ValueError(f"a level of {bits} bits is over the bound of {MAX_BITS}")
    hashes = max(1, round(bits / count * log(2)))
    place = F.explode(_places(F.col("key"), number, bits, hashes))
    words = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("value"))
    )
    found = {row.word: row.value for row in words.collect()}
    return Level(bits, hashes, tuple(found.get(i, 0) for i in range(bits // 64)))


def cascade(universe: DataFrame, listed: list[str]) -> list[Level]:
    """Filters that tell the listed keys from all other keys of the universe (a frame with a column key)."""
    if not listed:
        return []
    listed = sorted(set(listed))
    inside = universe.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, listed))).alias("key"))
    others = universe.where(~F.col("key").isin(listed))
    total, count = others.count(), len(listed)
    levels: list[Level] = []
    rate = min(0.5, count / sqrt(2) / max(total, 1))
    while count:
        own, other = (inside, others) if len(levels) % 2 == 0 else (others, inside)
        level = _level(own, len(levels), count, rate)
        through = durable(other.where(level.passes(F.col("key"), len(levels))))
        levels.append(level)
        count = through.count()
        if len(levels) % 2:
            others = through
        else:
            inside = through
        rate = 0.5
    return levels


def listed(key: Column, levels: list[Level]) -> Column:
    """Whether the cascade says that a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[number].passes(key, number), F.lit(number % 2 == 1)).otherwise(out)
    return out


FITTING = "array<struct<size:int,key:string,verdict:string>>"


def _listed_keys(own: Column, levels: list[Level], verdict: str) -> Column:
    """The keys that the cascade has, with their length first."""
    mine = F.filter(own, lambda key: listed(key, levels))
    return F.transform(
        mine, lambda key: F.struct(F.length(key).alias("size"), key.alias("key"), F.lit(verdict).alias("verdict"))
    )


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    lengths = sorted({len(r.path) for r in rules})
    host, path = parts(F.col("url"))
    split = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"), (F.instr("url", "://") > 0).alias("is_url")
    )
    nothing = F.array().cast("array<string>")
    own = F.when(F.col("is_url"), keys(F.col("host"), F.col("path"), lengths) if lengths else nothing).otherwise(nothing)
    # hosts and beginnings of paths repeat a lot: keys are made from the distinct pairs
    longest = max(lengths, default=0)
    pairs = split.select("host", F.substring("path", 1, longest).alias("path"), "is_url").distinct()
    universe = durable(pairs.select(F.explode(own).alias("key")).distinct())
    verdicts = list(dict.fromkeys(r.verdict for r in rules))
    cascades = {v: cascade(universe, [r.key for r in rules if r.verdict == v]) for v in verdicts}

    fitting = F.concat(*[_listed_keys(own, cascades[v], v) for v in verdicts], F.array().cast(FITTING))
    best = F.array_max(fitting)
    return split.select("page_id", "host", "path", best.alias("best")).select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
