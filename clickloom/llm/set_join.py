"""N-gram Jaccard join by a partitioned universe.

Every shingle hash belongs to one of m segments of the universe. Sets are grouped into
bands of sizes, chosen so that two sets that can link lie in one band or in
neighbouring ones. For a band, H is the largest symmetric difference that linked sets
can have. Segments get budgets: an exact segment tolerates no difference and spends one
unit, a one-deletion segment tolerates one difference and spends two. When the units
add up to H + 1, the pigeonhole principle leaves linked sets at least one segment
within its budget, so they share the hash of that segment or of a one-deletion
neighbour of it. Which kinds a band uses is settled by a cost model: one for each
signature written plus the expected number of chance candidates.

A segment without shingles, which all sets of a band could have in common, is no signature.
Instead there is a segment more than the budgets need (one that spends two units, if any
does): then linked sets have two segments within their budgets, and if the sets share
neither hash, both segments are thin in both sets, that is empty, or of one shingle if a
deletion is allowed. So each pair of thin segments is a signature.

Below ``WIDE_BELOW`` per cent the difference is so large that one-deletion segments alone
would give each set several times as many signatures as it has shingles. There the cost
model counts fewer chance candidates for a signature written, so all but a few bands of
small sets have exact segments only. Those bands get ``WIDE_SPARE`` times as many segments,
of which a set sends its rarest only, as many as it and a linked set may differ in and one
more. The first segment that linked sets share in one order of all segments, filled ones
before empty ones, is among these for both, if they share a filled one. If they share none,
each has at most as many filled segments as they differ in; a set with so few sends as many
of its shingles, too, which are the segments of the finest partition. Segments that are
common in a sample of the documents come last in the order, so that no signature is left to
what many sets have; the sample changes the cost, not the result.

If asked, the signatures are not those of segments but
the set's first shingles in one order of all shingles, as many as a linked set may
lack and one more: two sets that link share one of those, whatever the order. Shingles
that are common in such a sample come last in the order, so that few sets meet by chance.

Candidates are then verified exactly on their whole shingle sets, but not all pairs of
a group of signature sharers are made: a star around the group's first member is
verified first, and after that only members of different components meet, and those of
first shingles only where the shared shingle can be the first that they share.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import Words, int_lists, mix, sliced, words_of
from clickloom.llm.components import components
from clickloom.sources.shared import discard, stage

SHINGLE_WORDS = 3
SIMILARITY = 90

# Of the cost model: how many sets a segment meets, and how often they share a shingle.
CROWD = 50
SHARED = 0.7

# Similarities under this count so many sets a segment instead; their signatures are dealt to
# the first rows of equal texts in so many portions, each of which is shuffled alone.
WIDE_BELOW = 85
WIDE_CROWD = 6
WIDE_SPARE = 2
WIDE_PORTIONS = 3
# Pairs do not meet again at a signature if they share one of so many before it.
WIDE_PRIOR = 8
# Documents looked at for common shingles or segments, how often one is seen there, and how many are kept.
SAMPLE_DOCUMENTS = 10_000
COMMON = 3
COMMON_SHINGLES = 1 << 17
NOTHING_COMMON = np.zeros(0, np.uint64), np.zeros(0, np.int64)

BITMAP_BITS = 256

# Bits of the filter that names the documents to be read again: 4 MB.
FILTER_BITS = 1 << 25


def bands(similarity: int) -> Iterator[tuple[int, int]]:
    """Smallest and largest set size of each band, without end."""
    low = 1
    while True:
        high = 100 * low // similarity
        yield low, high
        low = high + 1


@functools.lru_cache(maxsize=None)
def band_table(similarity: int, largest: int) -> list[tuple[int, int, int, int]]:
    """(low, high, exact segments, one-deletion segments) of the bands up to a size."""
    table = []
    for low, high in bands(similarity):
        differences = 2 * high * (100 - similarity) // (100 + similarity)
        table.append((low, high, *allocate(differences, high, CROWD if similarity >= WIDE_BELOW else WIDE_CROWD)))
        if low > largest:
            return table


def allocate(differences: int, size: int, crowd: float = CROWD) -> tuple[int, int]:
    """Cheapest (exact, one-deletion) numbers of segments.

    They spend differences + 1 units, and those of one segment more.
    """

    def exact(deletions: int) -> int:
        return max(0, differences + (3 if deletions else 2) - 2 * deletions)

    def cost(deletions: int) -> float:
        parts = exact(deletions) + deletions
        written = parts + size * deletions / parts
        return written + crowd * parts * SHARED ** (size / parts)

    best = min(range((differences + 2) // 2 + 2), key=cost)
    return exact(best), best


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """(digest of the word sequence, sorted distinct shingle hashes) of each text."""
    return _word_shingles(words_of(texts), width)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, as ``np.unique``; on as few values as a text has, sorting is faster."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]]


def _word_shingles(found: Words, width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    first, hashes = found.first, found.hash
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    span = max(0, len(hashes) - width + 1)
    rolled = np.zeros(span, np.uint64)
    for i in range(width):
        rolled += hashes[i : i + span] * factors[i]
    rolled = mix(rolled)
    for a, b in zip(first[:-1], first[1:]):
        words = hashes[a:b]
        digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
        if b - a >= width:
            yield digest, _distinct(rolled[a : b - width + 1])
        elif b > a:
            yield digest, mix((words * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield digest, words


def _bands_of(size: int, similarity: int) -> Iterator[tuple[int, int, int, int]]:
    """(number, high, exact segments, one-deletion segments) of the bands in which a set meets others."""
    table = band_table(similarity, 1 << (100 * size // similarity + 1).bit_length())
    own = next(i for i, (_, high, _, _) in enumerate(table) if size <= high)
    for number in (own, own + 1):
        low, *band = table[number]
        if 100 * size >= similarity * low:  # else too small for any set of that band
            yield number, *band


def _seen(values: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How often each value was seen, 0 if it is not among the common ones."""
    known, seen = common
    if not len(known):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, seen[at], 0)


def _salted(shingles: np.ndarray, number: int, parts: int) -> tuple[np.uint64, np.ndarray, np.ndarray]:
    """A band's salt, and the set's hashes there by segment with the segment of each."""
    salt = np.uint64((number + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
    token = mix(shingles ^ salt)
    segment = ((token >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    return salt, mix(token[order]), segment[order]


def spare_segments(shingles: np.ndarray, similarity: int) -> Iterator[tuple[np.ndarray, int]]:
    """(hashes, how many of them are sent) in each wide band of exact segments only.

    Of the filled segments, and, if they are too few, of the segments of one shingle.
    """
    size = len(shingles)
    for number, high, exact, deletions in _bands_of(size, similarity):
        if deletions:
            continue
        salt, token, segment = _salted(shingles, number, WIDE_SPARE * exact)
        begins = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
        label = mix(segment[begins].astype(np.uint64) + salt)
        filled = mix(np.add.reduceat(token, begins) ^ label)
        largest = min(high, 100 * size // similarity)
        sent = (100 - similarity) * (size + largest) // (100 + similarity) + 1
        yield filled, sent
        if len(filled) < sent:
            yield mix(token + salt), sent


def _wide_segments(shingles: np.ndarray, similarity: int) -> np.ndarray:
    """All hashes that ``spare_segments`` chooses from."""
    return np.concatenate([np.zeros(0, np.uint64), *(found for found, _ in spare_segments(shingles, similarity))])


def signatures(
    shingles: np.ndarray, similarity: int, common: tuple[np.ndarray, np.ndarray] = NOTHING_COMMON
) -> np.ndarray:
    """Hashes of the set's filled segments, of their one-deletion neighbours and of pairs of
    thin segments, for both bands; in wide bands without deletions, of its rarest segments.

    ``common`` is (sorted hashes of segments, how often each was seen) for these.
    """
    size = len(shingles)
    if not size:
        return np.zeros(0, np.int64)
    wide = similarity < WIDE_BELOW
    made = []
    if wide:
        for found, sent in spare_segments(shingles, similarity):
            if len(found) > sent:
                found = found[np.lexsort((found, _seen(found, common)))[:sent]]
            made.append(found)
    for number, _, exact, deletions in _bands_of(size, similarity):
        if wide and not deletions:
            continue
        parts = exact + deletions
        salt, token, segment = _salted(shingles, number, parts)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(token)])
        edges = np.searchsorted(segment, np.arange(parts + 1))
        total = sums[edges[1:]] - sums[edges[:-1]]
        label = mix(np.arange(parts, dtype=np.uint64) + salt)
        sizes = np.diff(edges)
        made.append(mix(total ^ label)[sizes > 0])
        if deletions:
            near = (segment >= exact) & (sizes[segment] > 1)
            made.append(mix((total[segment[near]] - token[near]) ^ label[segment[near]]))
        thin = np.flatnonzero(sizes < np.where(np.arange(parts) < exact, 1, 2))
        one, other = np.triu_indices(len(thin), 1)
        made.append(mix(mix(label[thin[one]]) + label[thin[other]]))
    return _distinct(np.concatenate(made)).view(np.int64)


def first_shingles(shingles: np.ndarray, similarity: int, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The set's first shingles in order, rare ones first: one more than a linked set may lack.

    A linked set has at least similarity per cent of them. ``common`` is (sorted shingles,
    how often each was seen); all others come before them, in the order of their hashes.
    """
    token = mix(shingles)
    needed = -(-similarity * len(shingles) // 100)
    order = np.lexsort((token, _seen(shingles, common)))[: len(shingles) - needed + 1]
    return token[order].view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each bucket; differing bits bound the difference."""
    odd = np.bincount((shingles & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(shingles: np.ndarray) -> bytes:
    """Number of shingles in each of about a quarter as many buckets, 255 at most."""
    buckets = 1 << max(3, (len(shingles) // 4).bit_length() - 1)
    place = (shingles & np.uint64(buckets - 1)).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=buckets), 255).astype(np.uint8).tobytes()


def least_difference(one: np.ndarray, other: np.ndarray) -> int:
    """The least symmetric difference that sets with two sketches can have."""
    one, other = one.astype(np.int64), other.astype(np.int64)
    while len(one) > len(other):
        one = one.reshape(2, -1).sum(axis=0)
    while len(other) > len(one):
        other = other.reshape(2, -1).sum(axis=0)
    return int(np.abs(one - other).sum())


PROFILE = (
    "doc_id bigint, text_hash bigint, source string, n_words bigint, digest binary, n_shingles bigint, p0 bigint, p1 bigint, p2 bigint, p3 bigint, "
    "sketch binary, signatures array<bigint>"
)


def _shingle_batches(batches, width: int, segments_at: int | None):
    for batch in batches:
        for part in sliced(batch, "text"):
            made = [shingles for _, shingles in shingle_sets(part.column("text"), width)]
            if segments_at is not None:
                made = [_wide_segments(shingles, segments_at) for shingles in made if len(shingles)]
            found = np.concatenate([np.zeros(0, np.uint64), *made])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])


def common_shingles(docs: DataFrame, width: int, segments_at: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, how often seen) of those that a sample of the documents has often.

    With ``segments_at``, a similarity, segments of wide bands instead of shingles.
    """
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    rows = (
        docs.select("text")
        .sample(share, seed=0)
        .mapInArrow(functools.partial(_shingle_batches, width=width, segments_at=segments_at), "shingle bigint")
        .groupBy("shingle")
        .agg(F.count("*").alias("seen"))
        .where(F.col("seen") >= COMMON)
        .orderBy(F.desc("seen"), "shingle")
        .limit(COMMON_SHINGLES)
        .toPandas()
    )
    known = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], rows["seen"].to_numpy(np.int64)[order]


def _profile_batches(batches, width: int, similarity: int, common, by_first: bool):
    signs = first_shingles if by_first else signatures
    known = NOTHING_COMMON if common is None else common.value
    for batch in batches:
        for part in sliced(batch, "text"):
            digests, sizes, bits, sketches, made = [], [], [], [], []
            words = words_of(part.column("text"))
            for digest, shingles in _word_shingles(words, width):
                digests.append(digest)
                sizes.append(len(shingles))
                bits.append(parities(shingles))
                sketches.append(sketch(shingles))
                made.append(signs(shingles, similarity, known))
            bits = np.array(bits)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    part.column("text_hash"),
                    part.column("source"),
                    pa.array(words.count, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    *[pa.array(bits[:, i]) for i in range(4)],
                    pa.array(sketches, pa.binary()),
                    int_lists(np.concatenate(made), [len(x) for x in made]),
                ],
                names=[field.split()[0] for field in PROFILE.split(", ")],
            )


def _set_batches(batches, width: int, wanted):
    """Shingle sets of the texts whose id falls on a set bit."""
    for batch in batches:
        place = batch.column("place").to_numpy()
        batch = batch.filter(pa.array((wanted.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
        for part in sliced(batch, "text"):
            made = list(shingle_sets(part.column("text"), width))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([d for d, _ in made], pa.binary()),
                    pa.array([s.tobytes() for _, s in made], pa.binary()),
                ],
                names=["doc_id", "digest", "shingles"],
            )


def id_place(column: str):
    """Place of an id in the bits of ``id_filter``."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the places that the ids fall on, of fixed size; others may share them."""
    rows = (
        ids.select(id_place("doc_id").alias("place"))
        .groupBy(F.shiftright("place", 15).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .toPandas()  # FILTER_BITS in all
    )
    bits = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for chunk, own in zip(rows["chunk"], rows["bits"]):
        bits[chunk] = np.frombuffer(own, np.uint8)
    return bits.reshape(-1)


def _sketch_batches(batches, similarity: int):
    """Pairs whose sketches leave it open whether they link."""
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        total = batch.column("total").to_numpy()
        least = [
            least_difference(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
            for x, y in zip(left, right)
        ]
        keep = np.array(least, np.int64) * (100 + similarity) <= (100 - similarity) * total
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verify_batches(batches, similarity: int):
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        keep = []
        for one, two in zip(left, right):
            x = np.frombuffer(one.as_buffer(), np.uint64)
            y = np.frombuffer(two.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= similarity * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _can_link(one: str, two: str, similarity: int):
    """Size and parity tests that no linked pair fails."""
    x, y = F.col(f"{one}.n_shingles"), F.col(f"{two}.n_shingles")
    differing = sum(
        (F.bit_count(F.col(f"{one}.p{i}").bitwiseXOR(F.col(f"{two}.p{i}"))) for i in range(4)), F.lit(0)
    )
    return (
        (100 * F.least(x, y) >= similarity * F.greatest(x, y))
        & (differing * (100 + similarity) <= (100 - similarity) * (x + y))
    )


def _may_meet(one: str, two: str, similarity: int):
    """Tests that a linked pair passes at the first of the signatures that it shares.

    There, no earlier shingle is shared. So the sets share no more than either has from
    there on, and if both have a shingle before, these differ.
    """
    x, y = F.col(f"{one}.n_shingles"), F.col(f"{two}.n_shingles")
    needed = similarity * (x + y)
    enough = [
        (size - F.col(f"{side}.at")) * (100 + similarity) >= needed for side, size in ((one, x), (two, y))
    ]
    return enough[0] & enough[1] & F.coalesce(F.col(f"{one}.before") != F.col(f"{two}.before"), F.lit(True))


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, similarity: int) -> DataFrame:
    """Those of the pairs (a, b) that link, written to the shared folder.

    Pairs whose sketches differ by more than linked sets may are dropped first, so that
    whole sets travel for few others. Sets are made again for documents in a pair only; a filter of fixed size over their
    ids keeps other texts out of the shuffle. A document is found by its id and the
    digest of its words, so repeated ids cannot be confused; rows that are repeated whole
    give one set.
    """
    met = stage(pairs, "met")
    x, y = (nodes.select(F.col("node").alias(c), "sketch", "n_shingles").alias(c) for c in ("a", "b"))
    sketched = met.join(x, "a").join(y, "b").select(
        "a",
        "b",
        F.col("a.sketch").alias("left"),
        F.col("b.sketch").alias("right"),
        (F.col("a.n_shingles") + F.col("b.n_shingles")).alias("total"),
    )
    pairs = stage(
        sketched.mapInArrow(functools.partial(_sketch_batches, similarity=similarity), "a bigint, b bigint"), "pairs"
    )
    discard(met)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = nodes.join(wanted, "node").select("node", "doc_id", "digest")
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(named))
    sets = docs.withColumn("place", id_place("doc_id")).mapInArrow(
        functools.partial(_set_batches, width=width, wanted=bits),
        "doc_id bigint, digest binary, shingles binary",
    )
    sets = sets.dropDuplicates(["digest", "doc_id"])
    same = sets["digest"].eqNullSafe(named["digest"]) & sets["doc_id"].eqNullSafe(named["doc_id"])
    sets = stage(named.join(sets, same).select("node", "shingles"), "sets")
    joined = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    links = stage(
        joined.mapInArrow(functools.partial(_verify_batches, similarity=similarity), "a bigint, b bigint"),
        "links",
    )
    discard(pairs, sets)
    return links


def text_hash(text):
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text.cast("string"))


def jaccard_components(
    documents: DataFrame,
    width: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
    by_row: bool = False,
    sized: bool = False,
    by_first: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): components of documents with similar shingle sets.

    Two documents link when 100 * intersection >= similarity * union of their sets of
    distinct shingles of ``width`` words; a text with fewer words is one shingle. Texts
    that are null or without words have no shingles and link with nothing. The component
    id is the smallest doc_id of the component, null if it has none. Rows that repeat a
    doc_id are texts of their own; ``by_row`` adds the column text_hash to find them by,
    ``sized`` the columns source and n_words. ``by_first`` takes first shingles instead of
    segments as signatures, with the same result. An empty table gives no rows; further
    columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if sized:
        docs = documents.select(*docs.columns, "source").withColumns(
            {c: F.col(c).cast(t) for c, t in (("doc_id", "bigint"), ("text", "string"), ("source", "string"))}
        )
    hashed = text_hash(F.col("text")) if by_row else F.lit(None).cast("bigint")
    given = docs.withColumn("text_hash", hashed)
    if not sized:
        given = given.withColumn("source", F.lit(None).cast("string"))
    docs = docs.select("doc_id", "text")
    common = None
    if by_first or similarity < WIDE_BELOW:
        found = common_shingles(docs, width, None if by_first else similarity)
        common = docs.sparkSession.sparkContext.broadcast(found)
    profiles = given.mapInArrow(
        functools.partial(_profile_batches, width=width, similarity=similarity, common=common, by_first=by_first),
        PROFILE,
    )
    # Numbers given before the write are fixed by it.
    profiles = stage(profiles.withColumn("node", F.monotonically_increasing_id()), "profiles")
    kept = ["doc_id", *(["text_hash"] if by_row else []), *(["source", "n_words"] if sized else []), "n_shingles"]
    filled = profiles.where("n_shingles > 0").drop("text_hash", "source", "n_words")
    # Equal word sequences are one node; copies meet nobody but their first row.
    first = filled.groupBy("digest").agg(F.min("node").alias("node"), F.min("doc_id").alias("low"))
    first = first.select("node", "low")
    if by_first or similarity >= WIDE_BELOW:
        # The long rows need no sorting: what they meet is narrow, one row a node.
        dealt = [stage(filled.join(first.hint("shuffle_hash"), "node"), "signed")]
    else:
        first = stage(first, "first")
        portion = F.pmod(F.xxhash64("node"), F.lit(WIDE_PORTIONS))
        dealt = [
            stage(filled.where(portion == n).join(first.where(portion == n).hint("shuffle_hash"), "node"), "signed")
            for n in range(WIDE_PORTIONS)
        ]
        discard(first)
    signed = functools.reduce(DataFrame.unionAll, dealt)
    rows = stage(profiles.select("digest", *kept), "rows")
    nodes = stage(signed.drop("signatures"), "nodes")
    discard(profiles)
    spread = signed.select("node", "signatures", F.posexplode("signatures").alias("at", "signature"))
    place = ["at", F.get("signatures", F.col("at") - 1).alias("before")] if by_first else []
    spread = spread.select("node", "signature", *place)
    shared = stage(
        spread.groupBy("signature")
        .agg(F.min("node").alias("pivot"), F.count("*").alias("sharers"))
        .where("sharers > 1"),
        "shared",
    )
    members = stage(spread.join(shared.hint("shuffle_hash"), "signature"), "members")
    discard(*dealt, shared)

    traits = nodes.select("node", "n_shingles", "p0", "p1", "p2", "p3")
    star = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = (
        star.join(traits.alias("x"), F.col("a") == F.col("x.node"))
        .join(traits.alias("y"), F.col("b") == F.col("y.node"))
        .where(_can_link("x", "y", similarity))
        .select("a", "b")
    )
    links = _verified(star, docs, nodes, width, similarity)

    # Members of a group that the star has not put into one component meet here. The
    # largest component of a group does not meet itself, so a large group of near copies
    # costs its few unlinked members times its size.
    roots = components(links)
    crowd = (
        members.where("sharers > 2")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    parts = crowd.groupBy("signature", "root").agg(F.count("*").alias("size"))
    mixed = (
        parts.groupBy("signature")
        .agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1")
    )
    # Written first, so that the join is between plain shuffles, which Spark splits if skewed.
    mixed = stage(mixed, "mixed")
    crowd = crowd.join(mixed, "signature")
    if similarity < WIDE_BELOW and not by_first:
        earlier = Window.partitionBy("node").orderBy("signature").rowsBetween(-WIDE_PRIOR, -1)
        crowd = crowd.withColumn("prior", F.collect_list("signature").over(earlier))
    crowd = stage(crowd.join(traits, "node"), "crowd")
    discard(members, roots, mixed)
    meeting = (
        (F.col("x.signature") == F.col("y.signature"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.node") != F.col("x.pivot"))
        & (F.col("y.node") != F.col("y.pivot"))
        & _can_link("x", "y", similarity)
    )
    if by_first:
        meeting &= _may_meet("x", "y", similarity)
    elif similarity < WIDE_BELOW:
        # Any signature that two members share is one of the crowd or was verified with the
        # star, so the least one suffices; near copies share many.
        meeting &= ~F.arrays_overlap("x.prior", "y.prior")
    rest = (
        crowd.where("root <> main")
        .alias("x")
        .join(crowd.alias("y"), meeting)
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )
    more = _verified(rest, docs, nodes, width, similarity)
    roots = components(links.unionAll(more))
    discard(crowd, links, more)
    placed = nodes.join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("root"), "low"
    )
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    by_digest = placed.join(lowest, "root").select("digest", "component_id")
    return rows.join(by_digest, "digest", "left").select(
        *kept,
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
