"""Parse, unnest and flatten nested payloads; page-merge of paged documents.

All operators here are narrow (no shuffle) except the page merges, which group by the
document key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_value(value: Column, dtype: T.DataType, path: str = "$") -> Column:
    """What a VARIANT holds at ``path``, in the declared type, field by field: a missing field, a null
    or a value that the type cannot hold is NULL and the other fields stay, as with ``from_json``.
    Unlike there, a value of another type is converted where a cast can (``"7"`` to 7, 1.5 to 1),
    and a struct that is missing has NULL fields. No text is parsed."""
    if isinstance(dtype, T.StructType):
        return F.struct(*[typed_value(value, f.dataType, f"{path}.{f.name}").alias(f.name) for f in dtype.fields])
    return F.try_variant_get(value, path, dtype.simpleString())


def explode_variant(df: DataFrame, value: str, array_path: str, element: T.StructType, alias: str,
                    carry: Iterable[str | Column] = ()) -> DataFrame:
    """:func:`explode_records` for documents held as VARIANT: one row per element of the array at
    ``array_path`` (a JSON path), with the declared fields of the element as the struct ``alias``.
    What is no array gives no row; an element that is null or no object has NULL fields. The array
    is cast once, value by value: one that does not fit is NULL and its record stays."""
    records = F.try_variant_get(F.col(value), array_path, T.ArrayType(element).simpleString())
    carry = [F.col(c) if isinstance(c, str) else c for c in carry]
    names = df.select(*carry).columns
    whole = df.select(*carry, records.alias("_records"))
    return explode_records(whole, "_records", alias, carry=names)


def explode_records(df: DataFrame, array_path: str, alias: str,
                    carry: Iterable[str | Column] = ()) -> DataFrame:
    """One output row per array element, parent columns carried along.

    Same rows as ``explode`` (a NULL or empty array yields no row; a NULL element yields a
    row), written as ``posexplode_outer`` + ``pos IS NOT NULL`` so that the optimizer does
    not infer a ``size(...) > 0`` filter that would evaluate the (JSON-parsing) array
    expression a second time below the generator.
    """
    exploded = df.select(*carry, F.posexplode_outer(F.col(array_path)).alias("_pos", alias))
    return exploded.where(F.col("_pos").isNotNull()).drop("_pos")


def flatten(df: DataFrame, mapping: Mapping[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Select nested fields under flat names (``{"player_name": "r.name", ...}``).
    A NULL parent struct yields a NULL child."""
    return df.select(*keep, *[F.col(path).alias(name) for name, path in mapping.items()])


def slice_records(df: DataFrame, array_path: str, n: int) -> DataFrame:
    """Keep the first ``n`` elements of a nested record array, envelope untouched."""
    parts = array_path.split(".")
    top = parts[0]
    sliced = F.slice(F.col(array_path), 1, n)
    if len(parts) == 1:
        return df.withColumn(top, sliced)
    return df.withColumn(top, F.col(top).withField(".".join(parts[1:]), sliced))


def merge_pages(df: DataFrame, keys: list[str], page: str, array: str,
                envelope: list[str] = ()) -> DataFrame:
    """Merge the pages of one pull into one document per key.

    The envelope columns come from the first page; the record arrays of all pages are
    concatenated in page order. A merged document is one row, so use this only where a
    key holds a bounded number of pages (one API pull); for unbounded groups use
    :func:`merged_positions`, which yields the same records without building the array.
    """
    aggs = [F.min_by(F.col(c), F.col(page)).alias(c) for c in envelope]
    pages = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(array).alias("a"))))
    aggs.append(F.flatten(F.transform(pages, lambda x: x["a"])).alias(array))
    return df.groupBy(*keys).agg(*aggs)


def merged_envelopes(df: DataFrame, keys: list[str], page: str, array: str,
                     envelope: list[str]) -> DataFrame:
    """The envelope of each merged document: the columns of its first page (ties go to the
    smallest values), with its ``pages`` and ``records``; the records themselves come from
    :func:`merged_positions`. One partial aggregate, no array is built."""
    first = F.min(F.struct(F.col(page), *envelope))
    out = df.groupBy(*keys).agg(first.alias("_first"), F.count(F.lit(1)).alias("pages"),
                                F.sum(F.coalesce(F.size(F.col(array)), F.lit(0))).alias("records"))
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in envelope], "pages", "records")


def merged_positions(df: DataFrame, keys: list[str], page: str, array: str,
                     value_name: str = "value", pos_name: str = "pos") -> DataFrame:
    """The records of the merged document, one row each, with their position in it.

    Equal to ``posexplode(merge_pages(...)[array])`` but distributed: the position of a
    page's first record is a running total of page sizes within the key, taken on the narrow table
    (key, page, size) and joined to the pages, and every page is exploded where it lies, so no key
    is gathered into one row or one task and no array is sorted or checkpointed. Pages go in the
    order of (page, records): a repeated page number counts once for each row, a NULL page
    comes first. Only rows that repeat a page number are ordered by their records.
    """
    from .ordinal import running_total

    n = F.coalesce(F.size(F.col(array)), F.lit(0)).cast("bigint")
    pages = df.select(*keys, page, array, n.alias("_n")).where(F.col("_n") > 0)
    sizes = pages.groupBy(*keys, page).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    starts = running_total(sizes, keys, [page], "_n", "_start")
    renamed = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, page])], "_rows", "_start")
    same = [pages[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate([*keys, page])]
    placed = pages.join(renamed, same).select(*pages.columns, "_rows", "_start")
    once = placed.where(F.col("_rows") == 1).select(*keys, array, "_start")
    if not starts.where(F.col("_rows") > 1).isEmpty():
        inner = running_total(placed.where(F.col("_rows") > 1).drop("_rows"), [*keys, page], [array], "_n", "_inner")
        once = once.unionByName(inner.select(*keys, array, (F.col("_start") + F.col("_inner")).alias("_start")))
    out = once.select(*keys, "_start", F.posexplode(array).alias("_idx", value_name))
    return out.select(*keys, (F.col("_start") + F.col("_idx")).cast("bigint").alias(pos_name), value_name)
