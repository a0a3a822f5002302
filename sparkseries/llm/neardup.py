"""Near-duplicates by the Jaccard similarity of word shingles: SimHash links first, MinHash bands name the rest, exact sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.common import give_back_memory, raw_text, stored, word_blocks
from sparkseries.llm.components import components
from sparkseries.llm.simhash import bit_counts, close_pairs, majority

_SEED = 42
_BANDS, _ROWS = 28, 5
_ODD = np.random.default_rng(_SEED).integers(0, 1 << 63, (_BANDS * _ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_blocks(data: bytes, words_per_shingle: int) -> Iterator[np.ndarray]:
    """XXH64 values of a text's word shingles in order, block by block; a shorter text is one shingle, one without words has none."""
    k, carry, some = words_per_shingle, [], False
    for block in word_blocks(data.lower()):
        words = carry + block
        if len(words) >= k:
            some = True
            shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(_SEED)), np.uint64)
        carry = words[max(0, len(words) - k + 1) :]
    if carry and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), _SEED)], np.uint64)


def signature(data: bytes, words_per_shingle: int) -> tuple[bytes, int, list[int]]:
    """128 bits that name the text's sequence of shingles, its SimHash, and the keys of its MinHash bands; no text is held as one list."""
    name = xxhash.xxh3_128()
    least = np.full(_BANDS * _ROWS, np.iinfo(np.uint64).max)
    ones, total = np.zeros(64, np.int64), 0
    for values in shingle_blocks(data, words_per_shingle):
        name.update(values.tobytes())
        ones += bit_counts(values)
        total += len(values)
        for at in range(0, len(values), 1024):
            np.minimum(least, (values[at : at + 1024] * _ODD).min(axis=1), out=least)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(_BANDS, _ROWS))] if total else []
    return name.digest(), majority(ones, total), np.array(keys, np.uint64).view(np.int64).tolist()


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices; what a task before left unused and what this one leaves goes back to the system."""
    give_back_memory()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back_memory()


def _signed(words_per_shingle: int):
    def run(batches):
        kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64())]
        for batch in _slices(batches):
            made = [signature(t, words_per_shingle) for t in batch.column(1).to_pylist()]
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "name", "fp", "keys"])

    return run


def signatures(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int) -> DataFrame:
    """``(id, name, fp, keys)`` of every row; the whole text is read, null counts as empty."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), raw_text(text_col).alias("text"))
    return source.mapInArrow(_signed(words_per_shingle), "id long, name binary, fp long, keys array<long>")


def _listed(words_per_shingle: int):
    def run(batches):
        for batch in _slices(batches):
            names, sets = [], []
            for data in batch.column(0).to_pylist():
                values = np.concatenate([np.zeros(0, np.uint64), *shingle_blocks(data, words_per_shingle)])
                names.append(xxhash.xxh3_128_digest(values.tobytes()))
                sets.append(np.unique(values).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["name", "shingles"])

    return run


def shingle_sets(docs: DataFrame, text_col: str, words_per_shingle: int) -> DataFrame:
    """``(name, shingles)``: the distinct shingles of every row's text."""
    return docs.select(raw_text(text_col).alias("text")).mapInArrow(_listed(words_per_shingle), "name binary, shingles array<long>")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(u, v)`` whose shingle sets have at least that Jaccard similarity."""
    one = sets.select(F.col("name").alias("u"), F.col("shingles").alias("a"))
    two = sets.select(F.col("name").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(one, "u").join(two, "v").withColumn("shared", F.size(F.array_intersect("a", "b")))
    return both.where(F.col("shared") / (F.size("a") + F.size("b") - F.col("shared")) >= similarity).select("u", "v")


def _ordered(u: str, v: str) -> list[Column]:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def fingerprint_pairs(prints: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(u, v)`` of names by the SimHash ``fp`` of each: a fingerprint's least name with its others, and those least names within ``distance`` bits."""
    firsts = prints.groupBy("fp").agg(F.min("name").alias("first"))
    same = prints.join(firsts, "fp").where("first < name").select(F.col("first").alias("u"), F.col("name").alias("v"))
    one = firsts.select(F.col("fp").alias("u"), F.col("first").alias("a"))
    two = firsts.select(F.col("fp").alias("v"), F.col("first").alias("b"))
    return same.union(close_pairs(firsts.select("fp"), distance).join(one, "u").join(two, "v").select(*_ordered("a", "b"))).distinct()


def _may_reach(similarity: float, a: str, b: str) -> Column:
    """Whether two sets of ``n`` shingles can be similar if their first common one has ``pos`` rarer ones before it in each."""
    most = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return most / (F.col(f"{a}.n") + F.col(f"{b}.n") - most) >= similarity


def rare_items(numbered: DataFrame, sets: DataFrame) -> DataFrame:
    """``(no, n, s)``: every shingle of the classes ``(name, no)``; numbers in place of names, for these rows are shuffled three times."""
    return sets.join(numbered, "name").select("no", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))


def rare_posts(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(s, name, root, n, pos)``: the rarest shingles of each of the classes ``(name, root)``, those held once left out.

    All shingles have one order, by the number of classes that hold them.  Two
    sets of that similarity share one of the first ``n - similarity * n + 1`` in
    each, and the first that they share leaves enough behind it in both.
    """
    numbered = stored(placed.withColumn("no", F.monotonically_increasing_id()), "neardup-numbered")
    items = rare_items(numbered.select("name", "no"), sets)
    often = items.groupBy("s").agg(F.count("*").alias("held")).where("held > 1")
    own = Window.partitionBy("no")
    ranked = items.join(often, "s").withColumn("pos", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("held", "s")) - 1)
    posts = ranked.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-6)).select("s", "no", "n", "pos")
    posts = stored(posts, "neardup-rare")
    smallest = posts.groupBy("s").agg(F.min("n").alias("smallest"))
    rest = F.col("n") - F.col("pos")
    reach = rest / (F.col("n") + F.greatest(F.col("smallest") - rest, F.lit(0))) >= similarity
    posts = posts.join(smallest, "s").where(reach).join(numbered, "no")
    return stored(posts.select("s", "name", "root", "n", "pos"), "neardup-rare")


def rare_hubs(posts: DataFrame) -> DataFrame:
    """``(s, hub)``: of each shingle that several components hold, the post with the fewest rarer shingles."""
    ends = posts.groupBy("s").agg(F.min(F.struct("pos", "name", "n", "root")).alias("hub"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    return ends.where("lo < hi").select("s", "hub")


def hub_pairs(posts: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(u, v)`` of each post with its shingle's hub, if of another component."""
    both = posts.alias("a").join(rare_hubs(posts), "s").where((F.col("root") != F.col("hub.root")) & _may_reach(similarity, "a", "hub"))
    return both.select(*_ordered("a.name", "hub.name")).distinct()


def other_pairs(posts: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(u, v)`` across components that share a shingle; one of the two is not in the hub's component."""
    all_posts = posts.join(rare_hubs(posts), "s")
    a, b = all_posts.where("root <> hub.root").alias("a"), all_posts.alias("b")
    reach = (F.col("a.s") == F.col("b.s")) & (F.col("a.root") != F.col("b.root")) & _may_reach(similarity, "a", "b")
    return a.join(b, reach).select(*_ordered("a.name", "b.name")).distinct()


def links_across(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``(u, v)`` that join all components ``(name, root)`` with a pair of that similarity, found by rare shingles."""
    posts = rare_posts(placed, sets, similarity)
    tried = stored(hub_pairs(posts, similarity), "neardup-hubs")
    links = stored(similar(tried, sets, similarity), "neardup-links")
    one = placed.select(F.col("name").alias("u"), F.col("root").alias("a"))
    two = placed.select(F.col("name").alias("v"), F.col("root").alias("b"))
    joined = components(links.join(one, "u").join(two, "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    moved = posts.join(joined.withColumnRenamed("root", "to"), posts.root == joined.node, "left")
    moved = stored(moved.select("s", "name", F.coalesce("to", "root").alias("root"), "n", "pos"), "neardup-rare")
    rest = other_pairs(moved, similarity).join(tried, ["u", "v"], "left_anti")
    return links.union(similar(rest, sets, similarity))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, words_per_shingle: int = 5, distance: int = 3
) -> DataFrame:
    """``(id_col, component_id)`` of every row of ``docs``.

    Two texts are linked if the sets of their shingles of ``words_per_shingle``
    words (ASCII letters in lower case) have a Jaccard similarity of at least
    ``similarity``; ``component_id`` is the smallest id that links reach, the
    row itself included.  A text of fewer words is one shingle.  Null and empty
    texts, and texts without words, are copies of one another.  A row without
    an id takes part; it gets the smallest id of its component, or null where
    no row of it has one.  Repeated rows repeat in the result.  Other columns
    of ``docs`` are not read, whatever their names.  An empty table gives an
    empty result.

    A link is decided on the whole sets.  SimHash names the first pairs: texts
    whose 64-bit fingerprints of these shingles lie within ``distance`` bits,
    joined on blocks as in ``simhash.near_duplicates``.  Texts of lower
    similarity lie farther apart (0.8 is about 10 bits), so MinHash names what is
    left, 28 bands of 5 values: a pair of similarity 0.8 shares no band with
    probability 1.5e-5, one of 0.9 with 1e-11.  Equal texts are one class.

    Scale: texts are read once, those of classes that share a band or a
    fingerprint a second time.  In each bucket of a band that holds several
    components of SimHash links, all classes are compared with the smallest one,
    so a large group of near copies costs one pair a member and bucket.  The
    classes of buckets that still hold several components are joined on their
    rarest shingles (``rare_posts``), which is exact: first each with the class
    that has the fewest rarer ones, then across the components that are left.  A
    shared template is no rare shingle, so texts that share no more are no pair.
    """
    prints = stored(signatures(docs, id_col, text_col, words_per_shingle), "neardup")
    names = stored(prints.groupBy("name", "fp").agg(F.min("id").alias("least")), "neardup-names")
    posts = stored(prints.select("name", "keys").distinct().select("name", F.explode("keys").alias("key")), "neardup-posts")
    close = stored(fingerprint_pairs(names, distance), "neardup-close")
    buckets = posts.groupBy("key").count().where("count > 1").select("key")
    shared = stored(posts.join(buckets, "key").select("key", "name"), "neardup-shared")
    named = shared.select("name").union(close.select("u")).union(close.select("v")).distinct()
    named = stored(names.join(named, "name").select("name", "least"), "neardup-named")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    wanted = named.select("least").distinct()
    again = texts.join(wanted, texts.id == wanted.least, "left_semi").union(texts.where("id IS NULL"))
    sets = shingle_sets(again, "text", words_per_shingle).join(named.select("name"), "name", "left_semi")
    sets = stored(sets.groupBy("name").agg(F.any_value("shingles").alias("shingles")), "neardup-sets")

    same = stored(similar(close, sets, similarity), "neardup-links")
    placed = _placed(shared, components(same))
    firsts = placed.groupBy("key").agg(F.min(F.struct("name", "root")).alias("first"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    stars = placed.join(firsts.where("lo < hi").select("key", "first"), "key").where("root <> first.root")
    stars = stored(stars.select(F.col("first.name").alias("u"), F.col("name").alias("v")).distinct(), "neardup-stars")
    near = stored(same.union(similar(stars, sets, similarity)), "neardup-links")
    placed = _placed(placed.select("key", "name"), components(near))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    mixed = stored(placed.join(mixed, "key", "left_semi").select("name", "root").distinct(), "neardup-mixed")

    linked = components(near.union(links_across(mixed, sets, similarity)))
    rooted = names.join(linked, names.name == linked.node, "left").select("name", "least", F.coalesce("root", "name").alias("root"))
    rooted = stored(rooted, "neardup-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("name", "component_id")
    return prints.join(named, "name").select(F.col("id").alias(id_col), "component_id")


def _placed(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """``(key, name)`` with the root of each name's component, itself if it has no link."""
    found = posts.join(roots, posts.name == roots.node, "left").select("key", "name", F.coalesce("root", "name").alias("root"))
    return stored(found, "neardup-placed")
