"""Column and row reshaping."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import _col
from ..scale import fits, settle
from .joins import null_safe_join
from .scans import number_rows

# Most structs in one nested array.
NEST_ROWS = 65_536

# Header synonyms (upper case) and the standard column names.
HEADER_SYNONYMS = {
    "SNP": "SNP", "RSID": "SNP", "RS": "SNP", "VARIANT_ID": "SNP", "MARKERNAME": "SNP",
    "CHR": "CHR", "CHROM": "CHR", "CHROMOSOME": "CHR",
    "BP": "BP", "POS": "BP", "POSITION": "BP", "BASE_PAIR_LOCATION": "BP",
    "A1": "A1", "REF": "A1", "OTHERALLELE": "A1", "OTHER_ALLELE": "A1",
    "A2": "A2", "ALT": "A2", "EFFECTALLELE": "A2", "EFFECT_ALLELE": "A2",
    "FRQ": "FRQ", "MAF": "FRQ", "FREQ": "FRQ", "AF": "FRQ", "EAF": "FRQ",
    "EFFECT_ALLELE_FREQUENCY": "FRQ",
    "OR": "OR", "ODDS_RATIO": "OR",
    "BETA": "BETA", "B": "BETA", "SE": "SE", "Z": "Z",
    "P": "P", "PVAL": "P", "P_VALUE": "P",
    "N": "N", "GENE": "GENE", "LOCUS": "LOCUS", "L95": "L95", "U95": "U95",
}


def standardise_headers(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename columns to standard names by a case-blind synonym map; unknown
    names only become upper case."""
    names = mapping or HEADER_SYNONYMS
    return df.withColumnsRenamed({c: names.get(c.upper(), c.upper()) for c in df.columns})


def clean_name(name: str) -> str:
    """snake_case form of a column name."""
    words = re.sub(r"[^0-9A-Za-z]+", "_", name)
    words = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", words)
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", words)
    return words.strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    """snake_case all names; repeats get _2, _3, ..."""
    seen: dict[str, int] = {}
    names = []
    for c in map(clean_name, df.columns):
        seen[c] = seen.get(c, 0) + 1
        names.append(c if seen[c] == 1 else f"{c}_{seen[c]}")
    return df.toDF(*names)


def select_any(df: DataFrame, required: list[str], optional: dict[str, str] | None = None) -> DataFrame:
    """Required columns, and optional ones (name to type) as null when absent."""
    extra = [
        F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in (optional or {}).items()
    ]
    return df.select(*required, *extra)


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if re.search(pattern, c)])


def cast_matching(df: DataFrame, pattern: str, kind: str) -> DataFrame:
    """Cast the columns whose name matches; text that does not fit gives null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in df.columns if re.search(pattern, c)})


def unite(df: DataFrame, out: str, cols: list[str], sep: str = "_", remove: bool = True) -> DataFrame:
    """Paste columns into one; a missing value pastes as ``NA``."""
    text = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols])
    pasted = df.withColumn("_united", text)
    gone = cols if remove else [out] if out in df.columns else []
    return pasted.drop(*gone).withColumnRenamed("_united", out)


def separate(
    df: DataFrame, col: str, into: list[str], sep: str = r"[^0-9A-Za-z]+", regex: bool = True, keep: bool = False
) -> DataFrame:
    """Split a text column; extra pieces are dropped, missing ones null."""
    pieces = F.split(F.col(col), sep if regex else re.escape(sep))
    df = df.withColumn("_pieces", pieces)
    if not keep:
        df = df.drop(col)
    return df.withColumns({c: F.get("_pieces", F.lit(i)) for i, c in enumerate(into)}).drop("_pieces")


def explode_list(df: DataFrame, col: str, sep: str = ",", ordinal: str | None = None) -> DataFrame:
    """One row per piece of a delimited list, with the piece's place if asked."""
    place = ordinal or "_place"
    others = [c for c in df.columns if c != col]
    out = df.select(*others, F.posexplode(F.split(F.col(col), re.escape(sep))).alias(place, col))
    return out if ordinal else out.drop(place)


def nest(df: DataFrame, keys: list[str], out: str = "data", part: str = "part", max_rows: int = NEST_ROWS) -> DataFrame:
    """Rows of a group as sorted arrays of structs: keys, ``part``, ``out``.

    A group has a row for every ``max_rows`` of its rows, numbered from 0 by
    ``part``, so no array grows with the data.  Counts of a group come from an
    aggregate over its parts.  Groups that fit one row are gathered as they
    are; only the rows of larger ones are put in order to cut them.
    """
    rest = [c for c in df.columns if c not in keys]
    gathered = F.array_sort(F.collect_list(F.struct(*rest))).alias(out)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).withColumn("_large", F.lit(True)).drop("_n")
    large = settle(large)
    if large.isEmpty():
        return df.groupBy(*keys).agg(gathered).select(*keys, F.lit(0).alias(part), out)
    told = null_safe_join(df, F.broadcast(large) if fits(large) else large, keys)
    small = told.filter("_large IS NULL").groupBy(*keys).agg(gathered).select(*keys, F.lit(0).alias(part), out)
    numbered = number_rows(told.filter("_large").drop("_large"), [*keys, *rest], "_at")
    first = numbered.groupBy(*keys).agg(F.min("_at").alias("_first"))
    parts = null_safe_join(numbered, first, keys).withColumn(part, F.floor((F.col("_at") - F.col("_first")) / max_rows).cast("int"))
    return small.unionByName(parts.groupBy(*keys, part).agg(gathered))


def unnest(df: DataFrame, col: str) -> DataFrame:
    """Rows of an array of structs."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.inline(col))


def pivot_longer(df: DataFrame, ids: list[str], cols: list[str], names: str, values: str) -> DataFrame:
    return df.unpivot(ids, cols, names, values)


def pivot_wider(
    df: DataFrame, ids: list[str], names: str, value: str, levels: list, order: tuple[str, ...] = ()
) -> DataFrame:
    """One column per level; the levels are listed, so no extra pass finds them.

    Of several values for one cell the first in ``order`` is taken, and of those
    that ``order`` leaves equal the smallest.
    """
    cell = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_value")))
    wide = df.groupBy(*ids).pivot(names, levels).agg(F.min(cell))
    return wide.select(*ids, *[F.col(f"`{v}`._value").alias(str(v)) for v in levels])


def with_level(df: DataFrame, col: str, levels: list[str], out: str) -> DataFrame:
    """Place of a category in a listed order, null for categories not listed."""
    pairs = F.create_map(*chain.from_iterable((F.lit(v), F.lit(i + 1)) for i, v in enumerate(levels)))
    return df.withColumn(out, F.try_element_at(pairs, F.col(col)))


def append_rows(df: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """Append literal rows; columns the rows lack are null."""
    extra = df.sparkSession.createDataFrame([tuple(r.values()) for r in rows], schema)
    return df.unionByName(extra, allowMissingColumns=True)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union of unlike schemas by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sort_genomic(df: DataFrame, chrom: str = "chr", pos: str = "bp", *more: str) -> DataFrame:
    """Sort by chromosome and position with missing last; meant for sinks."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (chrom, pos, *more)])
