"""Text and number clean-up as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import _col, if_else

# Three-letter amino-acid codes and their one-letter forms.
AMINO_ACIDS = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C",
    "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P",
    "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V",
}

# Numbers of the lettered chromosomes.
LETTERED_CHROMOSOMES = {"X": "23", "Y": "24", "M": "25", "MT": "25"}


def to_number(c, kind: str = "double") -> Column:
    """Text to number; text that is no number gives null."""
    return _col(c).try_cast(kind)


def parse_sci(c) -> Column:
    """Printed scientific notation (``5.2 × 10−9``, ``1,234``) to double."""
    exponent = F.regexp_replace(_col(c), r"[!\s]*[×xX][!\s]*10\s*([−–-]?)\s*(\d+)", "e$1$2")
    plain = F.regexp_replace(F.regexp_replace(exponent, "[−–]", "-"), r"[,!\s]", "")
    return plain.try_cast("double")


def first_match(c, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, null where there is none."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace only the first match; ``pattern`` must hold no groups."""
    return F.regexp_replace(_col(c), rf"^(.*?)(?:{pattern})", "$1" + replacement)


def signif(c, digits: int) -> Column:
    """Round to significant digits, halves to even."""
    x = _col(c).cast("double")
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(x))).cast("int")
    up = F.pow(F.lit(10.0), F.abs(places).cast("double"))
    rounded = F.when(places >= 0, F.rint(x * up) / up).otherwise(F.rint(x / up) * up)
    return F.when(x == 0, x).otherwise(rounded)


def round_even(c, digits: int = 0) -> Column:
    """Round with halves to even."""
    scale = float(10 ** digits)
    return F.rint(_col(c).cast("double") * scale) / scale


def cap_infinite(c, cap: float) -> Column:
    """Replace infinite values of either sign by ``cap``."""
    x = _col(c)
    return if_else(F.abs(x) == F.lit(float("inf")), F.lit(float(cap)), x)


def floor_p(c, smallest: float = 1e-300) -> Column:
    """P value from text; unreadable text gives ``smallest``, a readable 0 stays."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(smallest))


def cut(c, breaks: list[float], labels: list[str]) -> Column:
    """Label the right-closed bin a number falls in; null outside all bins."""
    x = _col(c)
    bins = zip(breaks[:-1], breaks[1:], labels, strict=True)
    return reduce(
        lambda chain, b: chain.when((x > b[0]) & (x <= b[1]), F.lit(b[2])),
        bins,
        F.when(F.lit(False), F.lit(None).cast("string")),
    )


def chrom_to_int(c) -> Column:
    """``chr7``, ``7``, ``chrX``, ``MT`` to a chromosome number, others null."""
    bare = F.regexp_replace(_col(c), "^chr", "")
    number = reduce(
        lambda chain, kv: chain.when(bare == kv[0], F.lit(kv[1])),
        LETTERED_CHROMOSOMES.items(),
        F.when(bare.isNull(), F.lit(None).cast("string")),
    ).otherwise(bare)
    return number.try_cast("int")


def short_hgvs(c) -> Column:
    """Protein change without ``p.`` and with one-letter residues."""
    return reduce(
        lambda text, code: F.replace(text, F.lit(code[0]), F.lit(code[1])),
        AMINO_ACIDS.items(),
        F.regexp_replace(_col(c), r"^p\.", ""),
    )


def orient_hgvs(change, allele, minor) -> Column:
    """Swap the residues of a short change when the annotated allele is the major one."""
    text, pieces = _col(change), F.split(_col(change), r"\d{1,4}")
    residue = first_match(text, r"\d{1,4}")
    before, after = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    return if_else(
        _col(minor) == _col(allele),
        F.concat(before, residue, after),
        F.concat(after, residue, before),
    )
