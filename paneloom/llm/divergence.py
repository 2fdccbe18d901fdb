"""Source divergence audit: how far the word use of each source is from that of its language and of the other sources.

Each task folds whole documents into stripes, one per term of a language: in how many documents the term is, and how
often each source has it. Full tables of stripes are spilled, and the shuffle merges stripes by key. Divergences come from
the merged stripes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.tables import save, small_batches

LEAST_DOCS = 10  # a term counts in a language if so many of its documents hold it
TOP_TERMS = 10
SCALE, PRIOR = 1_000_000_000, 2  # shares are in billionths, after PRIOR more occurrences of every term

SPILL_BYTES = 128 << 20  # estimated size of a task's stripes before they are spilled
STRIPE_BYTES, ENTRY_BYTES, TERMS_A_BATCH = 420, 110, 16_384
TILE = 256  # sources of one side of a unit of pairs
CELLS = 1 << 16  # (term, source) cells of one unit, about

# The stripe of the empty term, which no text holds, counts the documents of each source.
STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"

# Bytes of a text: A-Z in lower case, a-z and whatever isn't ASCII as they are, the rest a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _texts(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def _spill(stripes: dict[bytes, dict[bytes, dict]]) -> Iterator[pa.RecordBatch]:
    for lang, own in stripes.items():
        terms = list(own)
        for start in range(0, len(terms), TERMS_A_BATCH):
            part = terms[start : start + TERMS_A_BATCH]
            held = [own[t] for t in part]
            docs = [stripe.pop(None) for stripe in held]
            offsets = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    _texts([lang] * len(part)), _texts(part), pa.array(docs, pa.int64()),
                    pa.ListArray.from_arrays(offsets, _texts(list(chain.from_iterable(held)))),
                    pa.ListArray.from_arrays(offsets, pa.array(list(chain.from_iterable(map(dict.values, held))), pa.int64())),
                ],
                names=["lang", "term", "docs", "sources", "counts"],
            )
    stripes.clear()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition's documents; under the key None a stripe has the number of its documents."""
    stripes: dict[bytes, dict[bytes, dict]] = {}
    held = 0
    for batch in batches:
        columns = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "source", "text")]
        for lang, source, text in zip(*columns):
            own = stripes.setdefault(lang, {})
            counts = Counter(text.translate(_LETTERS).split())
            counts[b""] = 1
            for term, n in counts.items():
                stripe = own.get(term)
                if stripe is None:
                    own[term] = {None: 1, source: n}
                    held += STRIPE_BYTES + ENTRY_BYTES + len(term)
                else:
                    stripe[None] += 1
                    if source in stripe:
                        stripe[source] += n
                    else:
                        stripe[source] = n
                        held += ENTRY_BYTES
            if held > SPILL_BYTES:
                yield from _spill(stripes)
                held = 0
    yield from _spill(stripes)


def _merged(table: pa.Table, least: int) -> tuple[pa.Table, pa.Table]:
    """(finished stripes in at least `least` documents, the stripe of the last key) of stripes sorted by key."""
    table = table.combine_chunks()
    n = table.num_rows
    new = np.ones(n, bool)
    for name in ("lang", "term"):
        column = table.column(name)
        changed = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy()
        new[1:] = changed if name == "lang" else new[1:] | changed
    starts = np.flatnonzero(new)
    docs = np.add.reduceat(table.column("docs").to_numpy(), starts)
    keep = (docs >= least) | pc.equal(table.column("term").take(pa.array(starts)), "").to_numpy()
    keep[-1] = True
    stays = np.repeat(keep, np.diff(np.r_[starts, n]))
    kept = table.filter(pa.array(stays)).combine_chunks()
    group = np.cumsum(new[stays]) - 1
    sources = kept.column("sources").combine_chunks()
    names = sources.flatten().dictionary_encode()
    codes, width = names.indices.to_numpy(), max(1, len(names.dictionary))
    cell = group[pc.list_parent_indices(sources).to_numpy()] * width + codes
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    counts = kept.column("counts").combine_chunks().flatten().to_numpy()[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts, first) if len(cell) else counts
    owner, code = np.divmod(cell[first], width)
    offsets = pa.array(np.searchsorted(owner, np.arange(int(keep.sum()) + 1)), pa.int32())
    at = pa.array(starts[keep])
    found = pa.table(
        {
            "lang": table.column("lang").take(at), "term": table.column("term").take(at), "docs": pa.array(docs[keep]),
            "sources": pa.ListArray.from_arrays(offsets, names.dictionary.take(pa.array(code))),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(sums)),
        }
    )
    return found.slice(0, found.num_rows - 1), found.slice(found.num_rows - 1)


def _merge(least: int):
    """Merges stripes that arrive sorted by key; of an unfinished key only its sums are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if batch.num_rows:
                one = pa.Table.from_batches([batch])
                done, held = _merged(one if held is None else pa.concat_tables([held, one]), least)
                yield from done.to_batches()
        if held is not None and (held["docs"][0].as_py() >= least or held["term"][0].as_py() == ""):
            yield from held.to_batches()

    return run


def term_stripes(
    docs: DataFrame, least_docs: int = LEAST_DOCS, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """(lang, term, docs, sources, counts) of the terms in at least `least_docs` documents of their language.

    A term is a longest run of ASCII letters and characters beyond ASCII, with A-Z in lower case. One more stripe per
    language, with the empty term, has every source and its number of documents. Whole documents are
    folded where they are read, so a hot source or term costs one stripe per task and spill, not a row per occurrence.
    """
    small_batches(docs.sparkSession)
    clean = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))))
    folded = clean.mapInArrow(_fold, STRIPE)
    # Sorted by a hash first, which is cheap to compare; language and term tell equal hashes apart.
    keyed = folded.withColumn("key", F.xxhash64("lang", "term"))
    dealt = keyed.repartition("key").sortWithinPartitions("key", "lang", "term").drop("key")
    return dealt.mapInArrow(_merge(least_docs), STRIPE)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact."""
    top = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", top, (total + PRIOR * terms).cast("decimal(20,0)"))


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """`share` of arrays: three steps of long division, so that nothing overflows below 9e15 occurrences."""
    quotient, rest = np.divmod(counts + PRIOR, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digits
    return 1 + quotient


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


def _unit_pairs(stripes: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of distances over a unit's stripes, for each source of its one tile with each of the other tile.

    Terms that neither source has count as their common distance at zero; the first unit of a
    language's chunks adds that for all terms, each unit the difference for its own.
    """
    if not sources.num_rows:
        return pa.table({c: pa.array([], pa.string()) for c in ("lang", "source", "item")} | {"value": pa.array([], pa.int64())})
    head = sources.slice(0, 1).to_pylist()[0]
    names = sources.column("source").to_pylist()
    tile = sources.column("tile").to_numpy()
    whole = sources.column("total").to_numpy() + PRIOR * head["terms"]
    left, right = np.flatnonzero(tile == head["one"]), np.flatnonzero(tile == head["two"])
    zero = shares(np.zeros(len(names), np.int64), whole) if head["terms"] else np.ones(len(names), np.int64)
    at_zero = _distance(zero[left][:, None], zero[right][None, :])
    value = at_zero * (head["terms"] if head["chunk"] == 0 else 0)
    index = {s: i for i, s in enumerate(names)}
    rows = max(1, (1 << 20) // max(1, len(names), len(left) * len(right)))
    for start in range(0, stripes.num_rows, rows):
        part = stripes.slice(start, rows)
        counts = np.zeros((part.num_rows, len(names)), np.int64)
        for row, (own, n) in enumerate(zip(part.column("sources").to_pylist(), part.column("counts").to_pylist())):
            counts[row, [index[s] for s in own]] = n
        p = shares(counts, whole[None, :])
        value = value + (_distance(p[:, left][:, :, None], p[:, right][:, None, :]) - at_zero).sum(axis=0)
    i, j = (np.triu_indices(len(left), 1) if head["one"] == head["two"] else (x.ravel() for x in np.indices(value.shape)))
    one, two = [names[left[k]] for k in i], [names[right[k]] for k in j]
    return pa.table(
        {"lang": pa.array([head["lang"]] * len(one), pa.string()), "source": pa.array(one, pa.string()), "item": pa.array(two, pa.string()), "value": pa.array(value[i, j], pa.int64())}
    )


def _pair_sums(kept: DataFrame, stats: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each two sources of a language, once.

    A unit is a chunk of a language's terms with two tiles of its sources: a large language has many, and none
    is larger than about CELLS cells. Without over TILE sources every stripe is in one unit.
    """
    sized = langs.withColumn("tiles", F.ceil(F.col("n_sources") / TILE).cast("int"))
    sized = sized.withColumn("chunks", F.ceil((F.col("terms") * F.least(F.col("n_sources"), F.lit(2 * TILE)) + 1) / CELLS).cast("int"))
    sized = save(sized.select("lang", "tiles", "chunks"))
    tile_pairs = F.expr("flatten(transform(sequence(0, tiles - 1), a -> transform(sequence(a, tiles - 1), b -> struct(a as one, b as two))))")

    def tile(source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.col("tiles")).cast("int")

    units = ["lang", "chunk", "one", "two"]
    of_source = stats.join(sized, "lang").withColumn("tile", tile(F.col("source")))
    of_source = of_source.withColumn("pair", F.explode(tile_pairs)).where("tile in (pair.one, pair.two)")
    of_source = of_source.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    of_source = of_source.select("lang", "chunk", "pair.*", "source", "tile", "total", "terms")
    of_term = kept.join(sized, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
    of_term = of_term.withColumn("pair", F.explode(tile_pairs)).withColumn("own", F.filter(F.arrays_zip("sources", "counts"), lambda x: tile(x["sources"]).isin(F.col("pair.one"), F.col("pair.two"))))
    of_term = of_term.where("size(own) > 0").select("lang", "chunk", "pair.*", F.col("own.sources").alias("sources"), F.col("own.counts").alias("counts"))
    parts = of_term.groupBy(*units).cogroup(of_source.groupBy(*units)).applyInArrow(_unit_pairs, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergences(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    Part `pair` ranks all other sources of the language by their distance, part `term` the source's `top_terms`
    terms that it uses more than its language, by theirs. Shares are integers in billionths, distances are
    floor((p - q)^2 / (p + q)), summed over all terms kept; larger values come first, then smaller items by UTF-8.

    Null texts, languages and sources count as ''. A source without terms has pairs and no term rows; the only source
    of a language has no pairs. Repeated rows are documents of their own, very long texts are folded
    whole, an empty table gives an empty result, other columns are not read. No result depends on order or partitions.
    """
    stripes = save(term_stripes(docs, least_docs, text_column, lang_column, source_column))
    kept = stripes.where("term <> ''")
    entries = stripes.select(
        "lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("all"),
        F.explode(F.arrays_zip("sources", "counts")).alias("entry"),
    ).select("lang", "term", "all", "entry.sources", "entry.counts").toDF("lang", "term", "all", "source", "n")
    groups = entries.groupBy("lang", "source").agg(F.sum(F.when(F.col("term") != "", F.col("n")).otherwise(0)).alias("total"))
    groups = save(groups)
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("n_sources"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    langs = save(langs.join(terms, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0))))
    stats = save(groups.join(langs, "lang"))

    used = entries.where("term <> ''").join(stats, ["lang", "source"])
    used = used.withColumns({"p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("all"), F.col("lang_total"), F.col("terms"))})
    used = used.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = used.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)

    sums = save(_pair_sums(kept, stats, langs))
    both = sums.union(sums.select("lang", F.col("item"), F.col("source"), "value"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(best)
