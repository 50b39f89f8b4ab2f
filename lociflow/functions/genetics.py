"""Effect, frequency and sample-size formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nulls import _col, if_else, isin_, ratio

# Fixed value: normal quantile used for the 95% limit of a standard error.
Z95 = 1.96
# Fixed value: genome-wide significance.
GENOME_WIDE = 5e-8
# Frequencies too near one half to tell which allele is minor.
AMBIGUOUS_FREQUENCY = (0.42, 0.58)


def se_from_or_l95(odds_ratio, l95) -> Column:
    """Standard error from the odds ratio and its lower 95% limit."""
    return (F.log(_col(odds_ratio)) - F.log(_col(l95))) / Z95


def beta_from_z(z, frq, n) -> Column:
    """Effect per allele from the Z score, allele frequency and sample size."""
    zc, f = _col(z), _col(frq)
    return ratio(zc, F.sqrt(2 * f * (1 - f) * (_col(n) + zc * zc)))


def neff_4(n_ca, n_cn) -> Column:
    """Effective sample size of a case/control study, meta-analysis form."""
    one = F.lit(1.0)
    return ratio(F.lit(4.0), ratio(one, n_ca) + ratio(one, n_cn))


def neff_phi(n, n_ca) -> Column:
    """Effective sample size for power, n times phi times (1 - phi)."""
    phi = ratio(n_ca, n)
    return _col(n) * phi * (1 - phi)


def significant(df: DataFrame, p: str = "p", alpha: float = GENOME_WIDE) -> DataFrame:
    return df.filter(F.col(p) < alpha)


def with_effect_cols(df: DataFrame, odds_ratio="odds_ratio", l95="l95") -> DataFrame:
    """Add ``beta``, ``se`` and ``z`` from an odds ratio and its lower limit."""
    beta, se = F.log(_col(odds_ratio)), se_from_or_l95(odds_ratio, l95)
    return df.withColumns({"beta": beta, "se": se, "z": ratio(beta, se)})


def fold_maf(af, ref, alt) -> tuple[Column, Column]:
    """Minor allele frequency and minor allele; frequencies above one half flip."""
    f = _col(af)
    return if_else(f > 0.5, 1 - f, f), if_else(f > 0.5, _col(ref), _col(alt))


def major_minor(af, ref_seq, alt) -> tuple[Column, Column]:
    """Major and minor allele; at exactly one half both are the reference base."""
    f = _col(af)
    return if_else(f > 0.5, _col(alt), _col(ref_seq)), if_else(f < 0.5, _col(alt), _col(ref_seq))


def orient_to_minor(df: DataFrame, frq="frq", beta="beta", odds_ratio="odds_ratio") -> DataFrame:
    """Flip effects reported for the major allele and add ``maf``."""
    f, b, o = F.col(frq), F.col(beta), F.col(odds_ratio)
    major = f > 0.5
    return df.withColumns(
        {
            "maf": if_else(major, 1 - f, f),
            beta: if_else(major, -b, b),
            odds_ratio: if_else(major, ratio(F.lit(1.0), o), o),
        }
    )


def align_to_minor(
    df: DataFrame,
    minor: str = "minor",
    frq: str = "frq",
    odds_ratio: str = "odds_ratio",
    a1: str = "a1",
    a2: str = "a2",
    ambiguous: tuple[float, float] = AMBIGUOUS_FREQUENCY,
) -> DataFrame:
    """Re-express a row for the reference panel's minor allele.

    The flip is decided once per row, so all four columns move together; a
    missing minor allele leaves the decision, and so the columns, missing.
    """
    flip = (
        (F.col(minor) != F.col(a2))
        & (F.length(minor) == 1)
        & ~F.col(frq).between(*ambiguous)
    )
    new = {
        frq: if_else(flip, 1 - F.col(frq), F.col(frq)),
        odds_ratio: if_else(flip, ratio(F.lit(1.0), odds_ratio), F.col(odds_ratio)),
        a1: if_else(flip, F.col(a2), F.col(a1)),
        a2: if_else(flip, F.col(minor), F.col(a2)),
    }
    return df.withColumns(new)


def flip_listed(df: DataFrame, listed: list[str], snp="snp", a1="a1", a2="a2", frq="frq", beta="beta") -> DataFrame:
    """Swap alleles and effect of hand-listed variants; others stay."""
    flip = isin_(snp, listed)
    turned = {a1: F.col(a2), a2: F.col(a1), frq: 1 - F.col(frq), beta: -F.col(beta)}
    return df.withColumns({c: F.when(flip, new).otherwise(F.col(c)) for c, new in turned.items()})


def orient_freq(freq, reported_allele, tested_allele) -> Column:
    """Frequency of the tested allele when another allele was reported."""
    f = _col(freq)
    return if_else(_col(reported_allele) != _col(tested_allele), 1 - f, f)


def with_direction(df: DataFrame, odds_ratio: str = "odds_ratio") -> DataFrame:
    """Add ``dir``, the absolute ``effect`` and the display ``size``."""
    o = F.col(odds_ratio)
    effect = if_else(o > 1, o, ratio(F.lit(1.0), o))
    return df.withColumns(
        {
            "dir": if_else(o > 1, "risk", "protective"),
            "effect": effect,
            "size": if_else(effect < 1.2, 1.0, effect),
        }
    )
