"""Phrase collocations by Rabin-Karp fingerprints.

Every word and every n-gram of words gets a fingerprint from numpy prefix polynomials modulo 2^64: prefix sums over bytes give words,
prefix sums over word hashes give n-grams, each shifted back by an inverse power so that equal phrases have equal values wherever they
stand. A task sums occurrences by fingerprint and keeps a pointer to one of them; a shuffle adds these up. Phrases are counted length
by length: an n-gram is sent only if a filter of fixed size holds both of its parts of n - 1 words, which can't drop a frequent one.
A second polynomial with another base and other byte values tells collisions: a fingerprint under which it differs is counted again
with both. Only frequent phrases become text, read at their pointers and hashed again to verify them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwin.sources.sinks import staged
from llm.exprs import LOWER, UPPER
from llm.lookup import looked_up

BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
WORD = re.compile(rb"[^ \t.,;:!?\x0A-\x0D]+")
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Bytes of texts that are hashed at once; a longer text is hashed in parts that overlap by the words of a phrase less one.
AT_ONCE = 2_000_000
#: Bits of the filter that is sent to all tasks (16 MB).
FILTER_BITS = 27
#: A pointer is 33 bits of a document's hash and a byte offset of 31 bits.
OFFSET_BITS = 31
#: Parts in which a language's phrases are ranked before their best meet.
RANK_PARTS = 64
NO_LANGUAGE = "und"
_SEEDS = 11, 29


class Polynomial:
    """Fingerprints of words and n-grams by one base and one value for each byte."""

    def __init__(self, seed: int):
        import numpy as np

        random = np.random.default_rng(seed)
        self.values = random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(0, 1 << 61, dtype=np.uint64)) * 8 + 5
        self.powers, self.inverses = (np.ones(1, np.uint64) for _ in range(2))

    def _reach(self, count: int) -> None:
        import numpy as np

        if len(self.powers) < count:
            size = max(count, 1 << 16)
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _spans(self, values, starts, ends):
        """The polynomial of values[starts:ends], as if each began at place 0."""
        import numpy as np

        self._reach(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[:len(values)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def words(self, data, starts, ends):
        return self._spans(self.values[data], starts, ends)

    def grams(self, words, starts, n: int):
        return self._spans(words, starts, starts + n)


def _mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POLYNOMIALS: list[Polynomial] = []


def polynomials() -> list[Polynomial]:
    """The two polynomials, made once in a process."""
    if not _POLYNOMIALS:
        _POLYNOMIALS.extend(Polynomial(seed) for seed in _SEEDS)
    return _POLYNOMIALS


def _kinds():
    import numpy as np

    kinds = np.zeros(256, np.uint8)
    kinds[list(SPACES)], kinds[list(BREAKS)] = 1, 2
    return kinds


def _cut(data: bytes) -> Iterator[tuple[int, int]]:
    """(from, to) of parts of about AT_ONCE bytes that end with a word or a byte between words."""
    start = 0
    while start < len(data):
        end = min(len(data), start + AT_ONCE)
        if end < len(data) and (rest := WORD.match(data, end)):
            end = rest.end()
        yield start, end
        start = end


def grams(data: bytes, n: int):
    """Yields (starts, word hashes in two arrays, places of the first words): all n-grams of lower-case bytes, part by part.

    `starts` are byte offsets of all words of a part, `places` point into it; n-grams never cross a break.
    """
    import numpy as np

    kinds, carried, piece = _kinds(), None, 0
    for low, high in _cut(data):
        part = np.frombuffer(data, np.uint8, high - low, low)
        kind = kinds[part]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = kind == 0
        turns = np.diff(inside)
        starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        pieces = piece + np.cumsum(kind == 2)
        piece = int(pieces[-1])
        own = [starts + low, pieces[starts], *(p.words(part, starts, ends) for p in polynomials())]
        if carried is not None:
            own = [np.concatenate(x) for x in zip(carried, own)]
        places = np.arange(max(0, len(own[0]) - n + 1))
        places = places[own[1][places] == own[1][places + n - 1]]
        yield own[0], own[2:], places
        carried = [x[len(x) - min(len(x), n - 1):] for x in own]


def _language(lang: str) -> tuple[int, int]:
    from xxhash import xxh64_intdigest

    return tuple(xxh64_intdigest(lang.encode(), seed) for seed in _SEEDS)


def _prints(n: int, words, places, first, second, bits: int):
    """(fingerprint, check) of the n-grams at `places`, with the hashes of their languages."""
    import numpy as np

    found = [_mixed(p.grams(w, places, n) + lang + np.uint64(n)) for p, w, lang in zip(polynomials(), words, (first, second))]
    return found[0] & np.uint64((1 << bits) - 1), found[1]


def _probes(prints):
    """The two places of a fingerprint in the filter."""
    import numpy as np

    low = np.uint64((1 << FILTER_BITS) - 1)
    return prints & low, (prints >> np.uint64(32)) & low


def _held(filter_bits, prints):
    import numpy as np

    held = np.ones(len(prints), bool)
    for at in _probes(prints):
        held &= (filter_bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return held


def _filter(prints: DataFrame):
    """A filter of the fingerprints in `fp`: at most 2^FILTER_BITS bits, put together by Spark eight bytes at a time."""
    import numpy as np

    low = (1 << FILTER_BITS) - 1
    places = F.explode(F.array(F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 32).bitwiseAND(low)))
    words = prints.select(places.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    found = words.toArrow()
    whole = np.zeros(1 << FILTER_BITS - 6, np.int64)
    whole[np.asarray(found.column("word"))] = np.asarray(found.column("bits"))
    return whole.astype("<i8").view(np.uint8)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, bytes]]:
    """Documents (key, lang, text as bytes) as they come, about AT_ONCE bytes at a time, and their texts joined by line ends."""
    held, size = [], 0
    for batch in batches:
        for key, lang, text in zip(*batch.columns):
            # as bytes, so that no text is decoded
            held.append((key.as_py(), lang.as_py(), text.as_py().translate(LOWERED)))
            size += len(held[-1][2]) + 1
            if size >= AT_ONCE:
                yield held, b"\n".join(t for _, _, t in held)
                held, size = [], 0
    if held:
        yield held, b"\n".join(t for _, _, t in held)


def _counted(n: int, known, bits: int):
    """Rows (fp, n, checked, amount, place) of the n-grams in a task's documents; n = 0 counts the words of a language."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["fp", "n", "checked", "amount", "place"]

        def rows(of: int, prints, checks, amounts, pointers) -> pa.RecordBatch:
            columns = [x.astype(np.int64) for x in (prints, checks, amounts, pointers)]
            columns.insert(1, np.full(len(prints), of, np.int8))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for docs, data in _chunks(batches):
            opened = np.concatenate([[0], np.cumsum([len(t) + 1 for _, _, t in docs])])[:-1]
            keys = np.array([k for k, _, _ in docs], np.int64).view(np.uint64) >> np.uint64(OFFSET_BITS) << np.uint64(OFFSET_BITS)
            hashed = {lang: _language(lang) for _, lang, _ in docs}
            first, second = (np.array([hashed[lang][i] for _, lang, _ in docs], np.uint64) for i in (0, 1))
            totals: dict = {}
            for starts, words, places in grams(data, n):
                if not len(places):
                    continue
                if n == 1:
                    owners, sizes = np.unique(np.searchsorted(opened, starts, "right") - 1, return_counts=True)
                    for owner, size in zip(owners.tolist(), sizes.tolist()):
                        lang = docs[owner][1]
                        before, key = totals.get(lang, (0, int(keys[owner])))
                        totals[lang] = before + size, key
                owner = np.searchsorted(opened, starts[places], "right") - 1
                if known is not None:
                    parts = [_prints(n - 1, words, at, first[owner], second[owner], bits)[0] for at in (places, places + 1)]
                    kept = _held(known, parts[0]) & _held(known, parts[1])
                    places, owner = places[kept], owner[kept]
                    if not len(places):
                        continue
                prints, checks = _prints(n, words, places, first[owner], second[owner], bits)
                order = np.argsort(prints, kind="stable")
                prints, checks = prints[order], checks[order]
                new = np.flatnonzero(np.concatenate([[True], (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])]))
                at = order[new]
                pointers = keys[owner[at]] | (starts[places[at]] - opened[owner[at]]).astype(np.uint64)
                yield rows(n, prints[new], checks[new], np.diff(np.append(new, len(prints))), pointers)
            for lang, (size, key) in totals.items():
                one = [np.array([x], np.uint64) for x in (*hashed[lang], size, key)]
                yield rows(0, *one)

    return count


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(F.xxhash64("text", lang).alias("key"), lang.alias("lang"), text.alias("text"))


def _read_back(bits: int):
    """Rows (lang, text, pointers) to (lang, n, phrase, fp, checked, a) of the pointers at which the phrase with that hash stands."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["lang", "n", "phrase", "fp", "checked", "a"]
        for batch in batches:
            met = []
            for lang, text, pointers in zip(*batch.columns):
                lang, text = lang.as_py(), text.as_py().translate(LOWERED)
                codes = _language(lang)
                for p in pointers.as_py():
                    at, words = p["place"] & (1 << OFFSET_BITS) - 1, []
                    while len(words) < p["n"] and (found := WORD.search(text, at)):
                        words.append(found[0])
                        at = found.end()
                    if len(words) == p["n"]:
                        met.append((lang, p["n"], b" ".join(words), p["fp"], p["checked"], p["a"], *codes))
            for n in sorted({m[1] for m in met}):
                own = [m for m in met if m[1] == n]
                first, second = (np.array([m[i] for m in own], np.uint64) for i in (6, 7))
                if n:
                    found = [(words, places) for _, words, places in grams(b"\n".join(m[2] for m in own), n)]
                    prints, checks, done = [], [], 0
                    for words, places in found:
                        part = slice(done, done + len(places))
                        for to, values in zip((prints, checks), _prints(n, words, places, first[part], second[part], bits)):
                            to.append(values)
                        done += len(places)
                    prints, checks = np.concatenate(prints).astype(np.int64), np.concatenate(checks).astype(np.int64)
                else:
                    prints, checks = first.astype(np.int64), second.astype(np.int64)
                same = (prints == np.array([m[3] for m in own])) & (checks == np.array([m[4] for m in own]))
                kept = [m for m, ok in zip(own, same) if ok]
                columns = list(zip(*(m[:6] for m in kept))) or [[]] * 6
                columns[2] = [p.decode() for p in columns[2]]
                kinds = [pa.string(), pa.int8(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return read


def frequent_phrases(docs: DataFrame, *, longest: int = 3, least: int = 10, bits: int = 64) -> DataFrame:
    """(lang, n, phrase, a): all phrases of 1 to `longest` words that occur at least `least` times in a language, and their counts.

    The row n = 0 holds the number of words of a language. `bits` shortens fingerprints (for tests of collisions).
    """
    texts, known, levels = _texts(docs), None, []
    for n in range(1, longest + 1):
        parts = texts.mapInArrow(_counted(n, known, bits), "fp bigint, n tinyint, checked bigint, amount bigint, place bigint")
        summed = parts.groupBy("n", "fp").agg(F.sum("amount").alias("a"), F.min("place").alias("place"), F.min("checked").alias("checked"),
                                              F.max("checked").alias("other"))
        often = staged(summed.where((F.col("a") >= least) | (F.col("n") == 0)), "fingerprints")
        mixed = often.where("checked != other")
        levels.append(often.where("checked = other").drop("other"))
        if mixed.count():
            again = parts.join(mixed.select("n", "fp"), ["n", "fp"], "left_semi").groupBy("n", "fp", "checked").agg(
                F.sum("amount").alias("a"), F.min("place").alias("place")).where((F.col("a") >= least) | (F.col("n") == 0))
            levels.append(staged(again.select(*levels[-1].columns), "collided"))
        if n < longest:
            known = _filter(often.where(F.col("n") == n))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    document = lambda c: F.shiftrightunsigned(c, OFFSET_BITS)
    pointers = found.groupBy(document("place").alias("document")).agg(F.collect_list(F.struct("n", "fp", "checked", "a", "place")).alias("pointers"))
    pointers = staged(pointers, "pointers")
    wanted = _filter(pointers.select(_spread("document").alias("fp")))

    def pointed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            kept = _held(wanted, np.asarray(batch.column(0)).astype(np.int64).view(np.uint64))
            yield batch.filter(pa.array(kept)).drop_columns(["spread"])

    aimed = texts.select(_spread(document("key")).alias("spread"), document("key").alias("document"), F.xxhash64("key", "text").alias("copy"), "lang", "text")
    aimed = aimed.mapInArrow(pointed, "document bigint, copy bigint, lang string, text binary")
    single = aimed.groupBy("document", "copy").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    met = single.join(pointers, "document").select("lang", "text", "pointers")
    read = met.mapInArrow(_read_back(bits), "lang string, n tinyint, phrase string, fp bigint, checked bigint, a bigint")
    return staged(read.groupBy("n", "fp", "checked").agg(F.first(F.struct("lang", "phrase", "a")).alias("r")).select("r.lang", "n", "r.phrase", "r.a"), "phrases")


def _spread(document: Column | str) -> Column:
    return F.xxhash64(document)


def collocations(docs: DataFrame, *, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2_000, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest` words by the score of their weakest cut.

    Texts are lower-cased (A-Z) and split at `.,;:!?` and line ends, words at spaces and tabs; a null text is empty, a null language
    `und`. A phrase counts with all its occurrences (a) if there are `least`; cut after k words, l and r are the counts of its parts and
    the score is floor(1000000 a a / (l r)), exactly. The lowest cut counts, ties to the smallest k. A phrase inside a longer one
    with at least `covered` percent of its occurrences is dropped. Ranks go by score and count, both descending, and phrase in byte
    order. Whole texts count, whatever their length, and repeated rows count again. Extra columns are ignored; an empty table, or one
    without frequent phrases, gives no rows.
    """
    found = frequent_phrases(docs, longest=longest, least=least, bits=bits)
    total = found.where("n = 0").select("lang", F.col("a").alias("n"))
    counts = found.where("n > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    phrases = found.where("n > 1").select("lang", "phrase", "n", "a", F.split("phrase", " ").alias("words"))
    joined = lambda start, size: F.concat_ws(" ", F.slice("words", start, size))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    sides = F.posexplode(F.array(joined(F.lit(1), F.col("k")), joined(F.col("k") + 1, F.col("n") - F.col("k")))).alias("side", "part")
    sides = looked_up(cuts.select("lang", "phrase", "a", "k", sides), ["lang", "part"], counts, "phrase")
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f")))
    cuts = sides.groupBy("lang", "phrase", "k").agg(F.max("a").alias("a"), of(0).alias("l"), of(1).alias("r"))
    wide = lambda c: f"cast({c} as decimal(15,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    scored = weakest.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r")
    # all shorter phrases inside a longer one, with the most occurrences of such a one
    sizes = F.explode(F.sequence(F.lit(2), F.col("n") - 1))
    inner = phrases.where("n > 2").withColumn("size", sizes).withColumn("start", F.explode(F.expr("sequence(1, n - size + 1)")))
    longer = inner.select("lang", joined(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {covered} * a")).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
