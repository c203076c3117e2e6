"""Sequence helpers as columns; the adapter and quality searches run on Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_MAX_CELLS = 1 << 22  # cells of one byte matrix, so that a batch of long reads stays small


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def revcomp(seq) -> Column:
    """Reverse complement; N and case are kept."""
    return F.reverse(F.translate(_col(seq), "ACGTNacgtn", "TGCANtgcan"))


def hamming(seq, text: str) -> Column:
    """Mismatches between the start of ``seq`` and a short constant; missing bases count as mismatches."""
    s = _col(seq)
    return sum((F.when(F.substring(s, i + 1, 1) == c, 0).otherwise(1) for i, c in enumerate(text)), F.lit(0))


def has_flag(flag, bit: int) -> Column:
    """Whether a SAM flag bit is set."""
    return _col(flag).bitwiseAND(bit) != 0


def cut_at_site(seq, site: str = "TTAA") -> Column:
    """Length kept when a read is cut at a restriction site: up to the first base of its first occurrence."""
    s = _col(seq)
    at = F.instr(s, site)
    return F.when(at > 0, at).otherwise(F.length(s))


def _byte_rows(texts: list[bytes], left: int, right: int):
    """Byte matrix of the texts, zero-padded; yields it in slices of bounded size."""
    start = 0
    while start < len(texts):
        # rows are added until the slice would exceed the cell budget
        stop, width = start, 1
        while stop < len(texts):
            wider = max(width, len(texts[stop]))
            if stop > start and (stop - start + 1) * (wider + left + right) > _MAX_CELLS:
                break
            stop, width = stop + 1, wider
        block = np.zeros((stop - start, left + width + right), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts[start:stop]), np.int64, stop - start)
        block[:, left:left + width][np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(texts[start:stop]), dtype=np.uint8)
        yield start, stop, width, block
        start = stop


def adapter_match(seq, adapter: str, end: str, min_overlap: int, error_rate: float) -> Column:
    """Best ungapped match of an adapter: ``struct(start, stop, errors)`` in read coordinates, NULL without one.

    At least ``min_overlap`` adapter bases must match the read with at most ``floor(error_rate * overlap)``
    mismatches; an overlap shorter than the adapter is allowed only at the read's own ``end`` (``5p`` or
    ``3p``). The best match has the most equal bases, then the fewest errors, then the leftmost start.
    """
    if end not in ("5p", "3p"):
        raise ValueError("end must be 5p or 3p")
    pattern = np.frombuffer(adapter.encode(), dtype=np.uint8)
    m = len(pattern)
    left = max(m - min_overlap, 0) if end == "5p" else 0
    right = m
    allowed = np.array([int(error_rate * o + 1e-9) for o in range(m + 1)])

    def find(batches):
        for series in batches:
            given = [(t or "").encode() for t in series]
            asked = np.array([i for i, t in enumerate(given) if t], dtype=np.int64)  # rows without a text cost nothing
            texts = [given[i] for i in asked]
            all_rows = np.full((3, len(given)), -1, dtype=np.int32)
            start, stop, errors = np.full((3, len(texts)), -1, dtype=np.int32)
            for lo, hi, width, block in _byte_rows(texts, left, right):
                lengths = np.array([len(t) for t in texts[lo:hi]], dtype=np.int32)
                places, within = left + width, block != 0
                differ = {base: ((block != base) & within).view(np.uint8) for base in set(pattern.tolist())}
                wrong = np.zeros((hi - lo, places), dtype=np.uint8 if m < 256 else np.uint16)
                for j, base in enumerate(pattern.tolist()):
                    wrong += differ[base][:, j:j + places]
                at = np.arange(places, dtype=np.int32) - left
                # at the far end of the read only a whole adapter counts for 5p
                last = lengths - (m if end == "5p" else min_overlap)
                row, place = np.nonzero((wrong <= allowed[m]) & (at[None, :] <= last[:, None]))
                first = np.maximum(at[place], 0)
                overlap, errs = np.minimum(at[place] + m, lengths[row]) - first, wrong[row, place].astype(np.int64)
                valid = (overlap >= min_overlap) & (errs <= allowed[np.clip(overlap, 0, m)])
                row, first, overlap, errs = row[valid], first[valid], overlap[valid], errs[valid]
                # the best place of each row, the leftmost of equal ones
                order = np.lexsort((first, errs - (overlap - errs) * (m + 1), row))
                order = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
                found = lo + row[order]
                start[found], stop[found], errors[found] = first[order], first[order] + overlap[order], errs[order]
            all_rows[:, asked] = start, stop, errors
            yield pd.DataFrame(dict(zip(("start", "stop", "errors"), all_rows, strict=True)))

    # the iterator form is told apart by its type hints, set here to keep them real types
    from collections.abc import Iterator
    find.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    result = F.pandas_udf(find, T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "stop", "errors")]))
    # marked so that no filter takes a copy of the search with it; named once, so that it runs once
    hit = result.asNondeterministic()(_col(seq))
    return F.get(F.filter(F.array(hit), lambda h: h["start"] >= 0), F.lit(0))


def quality_summary(qual) -> Column:
    """``struct(lo, hi, total, n)``: least, greatest and summed Phred quality (base 33) and number of signs; NULL for no text."""

    def summed(batches):
        for series in batches:
            sizes = series.str.len().to_numpy(np.int64)
            codes = np.frombuffer("".join(series).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) - 33
            out, some = np.zeros((4, len(series)), np.int64), np.flatnonzero(sizes)
            if len(some):
                at = (np.cumsum(sizes) - sizes)[some]
                out[:3, some] = np.minimum.reduceat(codes, at), np.maximum.reduceat(codes, at), np.add.reduceat(codes, at)
            out[3] = sizes
            yield pd.DataFrame(dict(zip(("lo", "hi", "total", "n"), out, strict=True)))

    from collections.abc import Iterator
    summed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    result = F.pandas_udf(summed, T.StructType([T.StructField(c, T.LongType()) for c in ("lo", "hi", "total", "n")]))
    return F.when(_col(qual).isNotNull(), result.asNondeterministic()(F.coalesce(_col(qual), F.lit(""))))


def quality_keep(qual, cutoff: int = 20, base: int = 33) -> Column:
    """Bases kept by 3' quality trimming: the read is cut where the running sum of (cutoff - quality) from
    its end is greatest, looking no further than where the sum turns negative."""

    def keep(batches):
        for series in batches:
            texts = [(t or "").encode() for t in series]
            kept = np.zeros(len(texts), dtype=np.int32)
            # reversed, so that the 3' end is column 0 for every read
            for lo, hi, width, block in _byte_rows([t[::-1] for t in texts], 0, 0):
                lengths = np.array([len(t) for t in texts[lo:hi]], dtype=np.int32)
                inside = np.arange(width)[None, :] < lengths[:, None]
                gain = np.where(inside, cutoff + base - block.astype(np.int32), 0)
                total = gain.cumsum(axis=1)
                live = inside & (np.logical_or.accumulate(total < 0, axis=1) == False)  # noqa: E712
                total = np.where(live, total, 0)
                best = total.max(axis=1)
                cut = np.where(best > 0, total.argmax(axis=1) + 1, 0)
                kept[lo:hi] = lengths - cut
            yield pd.Series(kept)

    from collections.abc import Iterator
    keep.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(keep, T.IntegerType())(_col(qual))
