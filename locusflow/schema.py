"""Column conventions shared by all operators.

Coordinates are 0-based half-open ``(chrom, start0, end0)``. ``sample`` and ``tag`` are part of every
grouping key when present; tables without them (gene models, chromosome sizes) are shared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

RUN_KEY = ("sample", "tag")
SPAN = ["chrom", "start0", "end0"]


def run_keys(df: DataFrame) -> list[str]:
    """The part of ``(sample, tag)`` that ``df`` carries."""
    return [c for c in RUN_KEY if c in df.columns]


@dataclass(frozen=True)
class AdapterSet:
    """Sequences searched in the reads. The defaults are fixed values of the lentiviral protocol."""

    provirus: str = "AAAATCTCTAGCAGTGGCGCCCGAACAG"
    ltr: str = "GTCTGTTGTGTGACTCTGGTAAC"
    elongation: str = "TAGAGATCCCTCAGACCCTTTTAGTCAGTGTGGAAAATCTCTA"
    prefix: str = "GCA"
    linker_r1: str = "AGTCCCTTAAGCGGAGCCCT"
    linker_r2: str = "AGGGCTCCGCTTAAGGGACT"
    rc_ltr: str = "TGCTAGAGATTTTCCACACTGACTAAAAGGGTCTGAGGGATCTCTA"


# Half-widths in bp of the association windows, by window label.
WINDOWS = {"01kb": 50, "1kb": 500, "10kb": 5_000, "100kb": 50_000, "1Mb": 500_000}

# Promoter tiers as (label, length in bp), from the transcription start outwards.
PROMOTER_TIERS = (("core", 40), ("proximal", 160), ("distal", 800))
