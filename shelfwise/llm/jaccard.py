"""N-gram Jaccard join by token-combination prefixes, and the groups that its links form.

A document's set holds its distinct word ``SHINGLE``-grams as 64-bit hashes. Equal sets are one
class first, so a group of copies of any size is one member from there on. All tokens are put
into one global order, rare ones first: a shingle is as rare as its rarest word, by word counts
over all texts in ``CELLS`` hashed counters (a fixed size; crowding costs time, never a link).

Two sets that link share their first common token within both prefixes of s - ceil(t s) + 1
tokens, and two tokens within prefixes one longer. A rare token is indexed alone; tokens of the
frequent class (whose rarest word occurs ``FREQUENT`` times per document or more) are indexed
by pairs of the longer prefix in sets of up to ``PAIRED`` tokens. Pairs grow with the square of a set, so larger
sets index frequent tokens alone, and so do those that are small enough for pairs but within reach of a
larger one: two sets that link meet by pairs if both are small, else alone. A pair's first common token also bounds its overlap by what lies
behind it, and the parity bits of two sets (``BITS`` of them) bound their difference; both
bounds are exact, so they lose nothing. Pairs of larger sets are bounded once more, by parity bits as
many as their tokens, before any tokens are joined.

Within one index entry pairs are not spelled out: every member is compared with the entry's
least member, verified links give members labels (their least head, two steps up), and only members
of one entry with different labels are compared with each other, those outside the entry's most
frequent label against the rest. Every pair that could join two labels is verified on the sets.
Where an entry would spell out more than ``CROWD`` such pairs (unlike texts that share a passage),
its undecided members are indexed anew by their whole sets, in the order of the tokens' exact counts
among these members: what they share comes last then, and only what they have apart is indexed.

Defined cases: a NULL, empty or wordless text has the empty set and links with nothing; fewer
than ``SHINGLE`` words are one shingle; rows that share a doc_id are one node of the links;
rows without doc_id link with nothing and have no component; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import FILTER_BITS, filter_place, filter_words, hand_off, map_arrow, settled, sifted
from shelfwise.llm.components import components

SHINGLE = 3
#: Least intersection in hundredths of the union.
SIMILAR = 90
CELL_BITS = 18
FREQUENT = 0.125
BITS = 512
#: Tokens of a set whose frequent tokens are indexed by pairs, at most.
PAIRED = 400
#: Pairs that one entry's undecided members may spell out; members of larger entries get entries of their own.
CROWD = 1 << 14

_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False


def _words(column: pa.Array):
    buf, offsets = A.text_bytes(column)
    buf = A.lower(buf)
    start, end = A.runs(_INSIDE[buf], offsets)
    return A.word_hashes(buf, start, end), np.searchsorted(start, offsets)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count(batches):
    counts = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for batch in A.chunks(batches):
        counts += np.bincount(_cells(_words(batch.column("text"))[0]), minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["cell", "n"])


def word_classes(documents: DataFrame) -> np.ndarray:
    """Class of every word cell: four times the binary logarithm of its count, at most 255."""
    counted = map_arrow(documents.select("text"), _count, "cell long, n long", lean=True).groupBy("cell").agg(F.sum("n").alias("n"))
    rows = counted.select("cell", F.least(F.lit(255.0), 4 * F.log2("n")).cast("int").alias("c")).toPandas()
    out = np.zeros(1 << CELL_BITS, dtype=np.uint8)
    out[rows["cell"]] = rows["c"]
    return out


def shingles(column: pa.Array, n: int, classes: np.ndarray | None = None):
    """Distinct shingles of each text in order: (owner, hash, class), sorted by owner, class, hash."""
    hashes, first = _words(column)
    counts = np.diff(first)
    parts = []
    for size in range(1, n + 1):
        rows = np.flatnonzero(counts >= n) if size == n else np.flatnonzero(counts == size)
        many = counts[rows] - size + 1
        at = A.within(first[rows], many)
        window = A.window_hashes(hashes, size)[at] if len(at) else hashes[:0]
        kind = np.zeros(len(at), dtype=np.uint8)
        if classes is not None and len(at):
            kind = np.minimum.reduce([classes[_cells(hashes[at + k])] for k in range(size)])
        parts.append((np.repeat(rows, many), window, kind))
    owner, token, kind = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((token, kind, owner))
    owner, token, kind = owner[order], token[order], kind[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])
    return owner[fresh], token[fresh], kind[fresh]


def _keys(owner, token, kind, sizes, first, similar: int, frequent: int, paired: int):
    """(owner, key, place of its first token) of every index entry."""
    place = np.arange(len(owner)) - first[owner]
    # Distinct linked sets share at least two tokens for t above a half: their union holds 1 / (1 - t) or more.
    prefix = sizes - -(-similar * sizes // 100) + 1
    rare = kind < frequent
    # A set links with sizes from ``similar`` hundredths of its own on.
    alone = np.flatnonzero((rare | (100 * sizes > similar * paired)[owner]) & (place < prefix[owner]))
    out = [(owner[alone], A.mix(token[alone] ^ np.uint64(1)), place[alone])]
    often = np.flatnonzero(~rare & (sizes <= paired)[owner] & (place < prefix[owner] + 1))
    bounds = np.searchsorted(owner[often], np.arange(len(sizes) + 1))
    for d in np.flatnonzero(np.diff(bounds) > 1):
        own = often[bounds[d] : bounds[d + 1]]
        a, b = np.triu_indices(len(own), 1)
        key = A.window_hashes(token[own[a]] + np.uint64(2), 1) ^ A.mix(token[own[b]] + np.uint64(3))
        out.append((np.full(len(a), d), key, place[own[a]]))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _parity_mix(token: np.ndarray) -> np.ndarray:
    return A.mix(token ^ np.uint64(0x5555555555555555))


def _sets(classes, frequent: int, n: int, similar: int, paired: int):
    """Map function: signature, index entries and parity bits of every text's set."""

    def run(batches):
        for batch in A.chunks(batches):
            owner, token, kind = shingles(batch.column("text"), n, classes.value)
            rows = batch.num_rows
            first = np.searchsorted(owner, np.arange(rows + 1))
            sizes = np.diff(first)
            mixed = _parity_mix(token)
            sums = np.concatenate(([np.uint64(0)], np.cumsum(token, dtype=np.uint64)))
            other = np.concatenate(([np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)))
            own, key, place = _keys(owner, token, kind, sizes, first, similar, frequent, paired)
            order = np.argsort(own, kind="stable")
            bounds = np.searchsorted(own[order], np.arange(rows + 1)).astype(np.int32)
            keys = pa.ListArray.from_arrays(
                pa.array(bounds),
                pa.StructArray.from_arrays(
                    [pa.array(key[order].view(np.int64)), pa.array(place[order].astype(np.int32))], names=["key", "place"]
                ),
            )
            bit = (mixed % np.uint64(BITS)).astype(np.int64)
            odd = (np.bincount(owner * BITS + bit, minlength=rows * BITS) & 1).astype(bool).reshape(rows, BITS)
            words = np.packbits(odd, axis=1, bitorder="little").view(np.int64).reshape(rows, BITS // 64)
            parity = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * (BITS // 64)), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes.astype(np.int64)),
                    pa.array((sums[first[1:]] - sums[first[:-1]]).view(np.int64)),
                    pa.array((other[first[1:]] - other[first[:-1]]).view(np.int64)),
                    keys,
                    parity,
                ],
                names=["id", "n", "s1", "s2", "keys", "parity"],
            )

    return run


def _wide_parity(token: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Parity bits of the sets of more than ``BITS`` tokens, one to two for each token (a power of two); none of others."""
    sizes = np.diff(bounds)
    words = np.where(sizes > BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64) >> 6, 0)
    first = np.concatenate(([0], np.cumsum(words)))
    large = np.repeat(words > 0, sizes)
    own = np.repeat(np.arange(len(sizes)), sizes)[large]
    bit = (_parity_mix(token[large]) % (64 * words[own]).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(64 * first[own] + bit, minlength=64 * first[-1]) & 1
    packed = np.packbits(odd.astype(bool), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(packed))


def _tokens(n: int, wanted):
    """Map function: tokens of the texts whose id hash the filter lets through, and the large sets' parity bits."""

    def run(batches):
        for batch in A.chunks(batches):
            batch = batch.filter(pa.array(wanted.value[batch.column("h").to_numpy(zero_copy_only=False)]))
            if not batch.num_rows:
                continue
            owner, token, _ = shingles(batch.column("text"), n)
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(token.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, _wide_parity(token, bounds)], names=["id", "tokens", "parity"])

    return run


def _sets_of(texts: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(id, tokens, parity) of the documents in the pairs, and of few others; no text is shuffled.

    What reaches the driver is a bit set of FILTER_BITS, whatever the number of pairs.
    """
    spark = texts.sparkSession
    packed = filter_words(pairs.select(F.explode(F.array("a", "b")).alias("id")).select(filter_place("id").alias("h"))).collect()
    table = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    table[[r["w"] for r in packed]] = np.array([r["v"] for r in packed], dtype=np.int64).view(np.uint64)
    wanted = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").view(bool))
    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.where("doc_id is not null").select("doc_id", "text", filter_place("doc_id").alias("h"))
    return hand_off(map_arrow(rows, _tokens(n, wanted), f"id {kind}, tokens array<long>, parity array<long>", lean=True), "tokens")


def _near_enough(a: str, b: str, similar: int) -> Column:
    """Can two sets link, by what lies behind their first common token?"""
    overlap = F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place"))
    return 100 * overlap >= similar * (F.col(f"{a}.n") + F.col(f"{b}.n") - overlap)


def _alike(a: str, b: str, similar: int) -> Column:
    """Can two sets link, by their parity bits? |A - B| + |B - A| is at most (1 - t) / (1 + t) of |A| + |B|."""
    differ = F.aggregate(
        F.zip_with(F.col(f"{a}.parity"), F.col(f"{b}.parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v
    )
    return (100 + similar) * differ <= (100 - similar) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _folded(a: str, b: str) -> Column:
    """The parity bits of ``a``, of as few as ``b`` has; sizes of two sets that may link differ by one doubling at most."""
    words, half = F.col(f"{a}.parity"), F.size(f"{b}.parity")
    folded = F.zip_with(F.slice(words, F.lit(1), half), F.slice(words, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(words) == 2 * half, folded).otherwise(words)


def _unlike(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs of large sets that cannot link, by parity bits as many as tokens (``BITS`` say nothing about these)."""
    large = sets.where(F.size("parity") > 0).select("id", F.size("tokens").alias("n"), "parity")
    both = (
        pairs.join(large.alias("p"), F.col("a") == F.col("p.id"))
        .join(large.alias("q"), F.col("b") == F.col("q.id"))
        .select("a", "b", F.struct("p.n", "p.parity").alias("p"), F.struct("q.n", "q.parity").alias("q"))
    )
    both = both.select(
        "a", "b",
        F.struct("p.n", _folded("p", "q").alias("parity")).alias("p"),
        F.struct("q.n", _folded("q", "p").alias("parity")).alias("q"),
    )
    unequal = 100 * F.least("p.n", "q.n") < similar * F.greatest("p.n", "q.n")
    return both.where(unequal | ~_alike("p", "q", similar)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    near = hand_off(pairs.join(_unlike(pairs, sets, similar), ["a", "b"], "left_anti"), "near")
    _, needed = sifted(sets, [sets["id"]], near.select(F.explode(F.array("a", "b")).alias("id")))
    left = needed.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = needed.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    joined = near.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("ta", "tb"))
    return joined.where(100 * common >= similar * (F.size("ta") + F.size("tb") - common)).select("a", "b").distinct()


def _undecided(placed: DataFrame) -> DataFrame:
    """The rows of entries whose members lie in several components, with the entry's most frequent one as ``main``."""
    mixed = (
        placed.groupBy("key", "component").agg(F.count("*").alias("m"))
        .groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", "m").alias("main"))
        .where("parts > 1").select("key", "main")
    )
    return placed.join(mixed, "key")


def _meetings(rows: DataFrame, similar: int) -> DataFrame:
    """(a, b) of members that may link: those outside an entry's main component against the others of the entry."""
    return (
        rows.where("component != main").alias("x")
        .join(rows.alias("y"), F.col("x.key") == F.col("y.key"))
        .where(
            (F.col("x.component") != F.col("y.component"))
            & ((F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
            & _near_enough("x", "y", similar)
            & _alike("x", "y", similar)
        )
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )


def _crowd_entries(crowded: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Index entries of crowded members by single tokens, the rarest among these members first.

    Tokens that no other crowded member has come first in a set; they take places but need no entries.
    """
    whole = sets.select(F.monotonically_increasing_id().alias("row"), "id", F.size("tokens").cast("long").alias("n"), "tokens")
    spread = whole.join(crowded.select("id").distinct(), "id", "left_semi").select("row", "id", "n", F.explode("tokens").alias("key"))
    common = spread.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    own = Window.partitionBy("row")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("m", "key")) - 1
    ordered = spread.join(common, "key").select("id", "n", "key", place.alias("place"))
    within = ordered.where(100 * (F.col("n") - F.col("place")) >= similar * F.col("n"))
    return _undecided(hand_off(within.join(crowded, ["id", "n"]), "crowd-entries"))


def _crowd_meetings(crowded: DataFrame, texts: DataFrame, n: int, similar: int) -> DataFrame:
    """(a, b) of crowded members that may link, by their first common token in the order of ``_crowd_entries``.

    The smaller set of a pair shares 2t / (1 + t) of its tokens or more, so its part of the index is shorter:
    unlike sets that share a passage have the passage's tokens behind that part, and do not meet at all.
    """
    rows = _crowd_entries(crowded, _sets_of(texts, crowded.select(F.col("id").alias("a"), F.col("id").alias("b")), n), similar)
    rows = hand_off(rows, "crowd")
    small = rows.where((100 + similar) * (F.col("n") - F.col("place")) >= 2 * similar * F.col("n"))
    inside = F.col("component") == F.col("main")

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        return (
            x.alias("x").join(y.alias("y"), F.col("x.key") == F.col("y.key"))
            .where(
                (F.col("x.component") != F.col("y.component"))
                & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id"))))
                & _near_enough("x", "y", similar)
                & _alike("x", "y", similar)
            )
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        )

    return meet(small.where(~inside), rows).unionAll(meet(small.where(inside), rows.where(~inside))).distinct()


def link_groups(documents: DataFrame, n: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """Per document: doc_id, n_shingles, copies (size of its class of equal sets), component_id."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    total = documents.count()
    frequent = int(4 * np.log2(max(2.0, FREQUENT * total)))
    classes = spark.sparkContext.broadcast(word_classes(texts))
    base = hand_off(
        map_arrow(
            texts,
            _sets(classes, frequent, n, similar, PAIRED),
            f"id {kind}, n long, s1 long, s2 long, keys array<struct<key: long, place: int>>, parity array<long>",
            lean=True,
        ),
        "sets",
    )
    same = ["n", "s1", "s2"]
    groups = hand_off(
        base.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    # Of each class the least id is the member. Only rows of classes that may have copies are looked up.
    copied = hand_off(groups.where("copies > 1").select(*same, F.col("id").alias("member")), "copied")
    indexed = base.where((F.size("keys") > 0) & F.col("id").isNotNull())
    alone, several = sifted(indexed, [indexed[c] for c in same], copied.select(*same))
    copy = [several[c] == copied[c] for c in same] + [several["id"] != copied["member"]]
    members = alone.unionAll(several.join(copied, copy, "left_anti"))
    entries = members.select("id", "n", F.inline("keys"))
    shared = entries.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("least")).where("m > 1")
    postings = hand_off(entries.join(shared.select("key", "least"), "key"), "postings")
    marks = members.select("id", "n", "parity")

    heads = postings.where("id = least").select("key", F.col("id").alias("head"), "n", "place")
    first = (
        postings.where("id != least").alias("x")
        .join(heads.alias("y"), F.col("x.key") == F.col("y.key"))
        .where(_near_enough("x", "y", similar))
        .select(F.col("y.head").alias("a"), F.col("x.id").alias("b"))
        .distinct()
    )
    first = first.join(marks.alias("x"), F.col("a") == F.col("x.id")).join(marks.alias("y"), F.col("b") == F.col("y.id"))
    first = hand_off(first.where(_alike("x", "y", similar)).select("a", "b").distinct(), "pairs")
    links = settled(spark, lambda: _verified(first, _sets_of(texts, first, n), similar), "links")
    # Two steps towards the least head are enough to see most of what belongs together.
    label = links.groupBy("b").agg(F.min("a").alias("head"))
    above = label.select(F.col("b").alias("up"), F.col("head").alias("top"))
    label = hand_off(
        label.join(above, F.col("head") == F.col("up"), "left").select(F.col("b").alias("id"), F.coalesce("top", "head").alias("component")),
        "labels",
    )

    placed = (
        postings.join(label, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .select("key", "id", "n", "place", "component")
    )
    open_rows = hand_off(_undecided(placed).join(marks.select("id", "parity"), "id"), "open")
    crowds = (
        open_rows.groupBy("key").agg(F.count("*").alias("m"), F.count_if(F.col("component") != F.col("main")).alias("apart"))
        .where(F.col("m") * F.col("apart") > CROWD)
    )
    crowds = hand_off(crowds.select("key"), "crowds")
    second = _meetings(open_rows.join(crowds, "key", "left_anti"), similar)
    if not crowds.isEmpty():
        crowded = open_rows.join(crowds, "key", "left_semi").select("id", "n", "component", "parity").distinct()
        second = second.unionAll(_crowd_meetings(hand_off(crowded, "crowded"), texts, n, similar)).distinct()
    second = hand_off(second, "pairs")
    more = settled(spark, lambda: _verified(second, _sets_of(texts, second, n), similar), "links")
    whole = components(links.unionAll(more))
    found = groups.join(whole, "id", "left").select(*same, "copies", F.coalesce("component", "id").alias("component_id"))
    return (
        base.select("id", *same).join(found, same, "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("copies", F.lit(1)).alias("copies"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
    )


def one_of_each(documents: DataFrame, n: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """The documents, columns as they are, that stand for their group: the least doc_id's row.

    Of rows that share that doc_id the one with the least text hash stays, once; rows without
    doc_id or without words stay as they are.
    """
    spark = documents.sparkSession
    groups = settled(spark, lambda: link_groups(documents, n, similar).where("n_shingles > 0"), "groups")
    # Ids that do not stand for their group, or stand in several rows; any other worded row stays, and its text in place.
    head = F.col("doc_id") == F.col("component_id")
    decided = groups.where("doc_id is not null").groupBy(F.col("doc_id").alias("decided")).agg(
        F.count("*").alias("m"), F.max(head).alias("head")
    )
    decided = hand_off(decided.where("m > 1 or not head").select("decided", "head"), "decided")
    worded = F.length(F.trim(F.translate(documents["text"], "\t\n\x0b\x0c\r", "     "))) > 0
    stay, open_rows = sifted(documents, [documents["doc_id"]], decided.select("decided"), documents["doc_id"].isNotNull() & worded)
    # The columns are named by their frame, as the documents may have columns of the same names.
    stay = stay.unionAll(open_rows.join(decided, open_rows["doc_id"] == decided["decided"], "left_anti"))
    again = decided.where("head").select(F.col("decided").alias("again"))
    if again.isEmpty():
        return stay
    repeated = open_rows.join(again, open_rows["doc_id"] == again["again"], "left_semi")
    least = repeated.groupBy(F.col("doc_id").alias("again")).agg(F.min(F.xxhash64("text")).alias("least"))
    same = (repeated["doc_id"] == least["again"]) & (F.xxhash64(repeated["text"]) == least["least"])
    return stay.unionAll(repeated.join(least, same, "left_semi").dropDuplicates(["doc_id"]))


def op6_jaccard(documents: DataFrame) -> DataFrame:
    return link_groups(documents).select("doc_id", "n_shingles", "component_id", "copies")
