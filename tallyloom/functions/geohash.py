"""n-dimensional geohash: interleaved halving of one range per dimension."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction
from numbers import Real

from pyspark.sql import Column
from pyspark.sql import functions as F

Bound = Column | Real

# Up to this many bits per dimension the quotient that finds a cell is off by at
# most one cell.
MAX_DIRECT_DIGITS = 50
# Up to this many dimensions each has expressions of its own, the cells' in generated code;
# more are gone through as an array, so that plans stay small.
OWN_EXPRESSIONS = 8


def geohash_bits(
    ranges: Sequence[tuple[Bound, Bound]], digits: int, value: Column | Sequence[Column]
) -> Column:
    """Bit string with ``digits`` bits per dimension, dimensions interleaved.

    ``value`` is an array Column or one Column per dimension. Each bit tells
    whether the value is below the middle of the range left (0) or not (1), also
    for a value outside the range; a null coordinate gives null.

    Where the edges of all cells are exact doubles, the cell of a value follows from one
    division that is then checked against the cell's edges. Other ranges and ranges held in
    Columns are halved step by step. Both are SQL functions, for hashes of any length.
    """
    if digits < 1:
        raise ValueError("digits must be at least 1")
    for low, high in ranges:
        if isinstance(low, Real) and isinstance(high, Real) and not high > low:
            raise ValueError(f"empty or unitary range: ({low}, {high})")
    coordinates = _coordinates(value, len(ranges))
    exact = digits <= MAX_DIRECT_DIGITS and all(_exact_edges(low, high, digits) for low, high in ranges)
    if exact and len(ranges) <= OWN_EXPRESSIONS:
        edges = [(F.lit(float(low)), F.lit(float(high))) for low, high in ranges]
        cells = [_cell_number(x, *pair, digits) for x, pair in zip(coordinates, edges)]
        bits = _interleaved(cells, digits)
    else:
        bits = _woven(coordinates, [_checked_range(*pair) for pair in ranges], digits, exact)
    known = coordinates[0].isNotNull()
    for coordinate in coordinates[1:]:
        known = known & coordinate.isNotNull()
    if isinstance(value, Column):
        complaint = F.raise_error(F.lit(f"value should have {len(ranges)} dimensions"))
        return F.when(F.size(value) != len(ranges), complaint).when(known, bits)
    return F.when(known, bits)


def _coordinates(value: Column | Sequence[Column], size: int) -> list[Column]:
    if isinstance(value, Column):
        return [F.get(value, F.lit(dim)).cast("double") for dim in range(size)]
    if len(value) != size:
        raise ValueError(f"value should have {size} dimensions, not {len(value)}")
    return [coordinate.cast("double") for coordinate in value]


def _exact_edges(low: Bound, high: Bound, digits: int) -> bool:
    """True if every edge, as a multiple of one power of two, fits into 53 bits."""
    if not (isinstance(low, Real) and isinstance(high, Real)):
        return False
    start, end = Fraction(float(low)), Fraction(float(high))
    step = (end - start) / 2**digits
    unit = max(start.denominator, step.denominator)
    return unit < 2**1000 and max(abs(start), abs(end)) * unit <= 2**53


def _cell_number(x: Column, low: Column, high: Column, digits: int) -> Column:
    """Number of the cell of ``x`` among ``2**digits``; exact edges are assumed."""
    step = (high - low) / 2**digits
    guess = F.floor((x - low) / step)
    at_least = F.when(x < low + guess * step, guess - 1).otherwise(guess)
    exact = F.when(x >= low + (guess + 1) * step, guess + 1).otherwise(at_least)
    # NaN sorts above every number here and so ends up in the last cell.
    return F.when(x < low, 0).when(x >= high, 2**digits - 1).otherwise(exact).cast("bigint")


def _interleaved(cells: list[Column], digits: int) -> Column:
    """Bits of all cell numbers in turn."""

    def in_turn(numbers: Column) -> Column:
        each = [F.get(numbers, F.lit(dim)) for dim in range(len(cells))]
        return F.concat(*[_digit_bits(each, digits - 1 - d) for d in range(digits)])

    # An array of one, so that the cell numbers are worked out once, not once per digit.
    return F.get(F.transform(F.array(F.array(*cells)), in_turn), F.lit(0))


def _digit_bits(cells: list[Column], place: int) -> Column:
    """The bit of each cell number at ``place``, one after another as text."""
    code = F.lit(0).cast("bigint")
    for i, cell in enumerate(cells):
        bit = F.shiftright(cell, place).bitwiseAND(F.lit(1).cast("bigint"))
        code = code.bitwiseOR(F.shiftleft(bit, len(cells) - 1 - i))
    return F.lpad(F.bin(code), len(cells), "0")


def _woven(
    coordinates: list[Column], edges: list[tuple[Column, Column]], digits: int, exact: bool
) -> Column:
    """Bits of all dimensions in turn, from an array with the bits of each."""
    xs, lows, highs = F.array(*coordinates), *(F.array(*[pair[k] for pair in edges]) for k in (0, 1))

    def own(x: Column, low: Column, high: Column) -> Column:
        if exact:
            return F.lpad(F.bin(_cell_number(x, low, high, digits)), digits, "0")
        return _halved(x, low, high, digits)

    def each(start: Column) -> Column:
        return own(start["x"], start["low"], start["high"])

    zipped = F.transform(xs, lambda x, i: F.struct(x.alias("x"), F.get(lows, i).alias("low"), F.get(highs, i).alias("high")))

    def digit(number: int):
        return lambda one: F.substring(one, number, 1)

    def in_turn(dimensions: Column) -> Column:
        return F.concat(*[F.array_join(F.transform(dimensions, digit(d + 1)), "") for d in range(digits)])

    # An array of one, so that the dimensions' bits are worked out once.
    return F.get(F.transform(F.array(F.transform(zipped, each)), in_turn), F.lit(0))


def _checked_range(low: Bound, high: Bound) -> tuple[Column, Column]:
    low_column = (low if isinstance(low, Column) else F.lit(low)).cast("double")
    high_column = (high if isinstance(high, Column) else F.lit(high)).cast("double")
    complaint = F.raise_error(F.concat(F.lit("empty or unitary range up to "), high_column))
    checked = F.when(high_column > low_column, high_column).otherwise(complaint.cast("double"))
    return low_column, checked


def _halved(x: Column, low: Column, high: Column, digits: int) -> Column:
    """Bits of one dimension, by halving its range ``digits`` times."""

    def step(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        # NaN sorts above every number here and so is never below the middle.
        below = x < middle
        return F.struct(
            F.when(below, state["low"]).otherwise(middle).alias("low"),
            F.when(below, middle).otherwise(state["high"]).alias("high"),
            F.concat(state["bits"], F.when(below, "0").otherwise("1")).alias("bits"),
        )

    start = F.struct(low.alias("low"), high.alias("high"), F.lit("").alias("bits"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(digits)), start, step, lambda state: state["bits"])


def box_intervals(
    ranges: Sequence[tuple[Real, Real]],
    digits: int,
    low: Sequence[Real],
    high: Sequence[Real],
    limit: int = 64,
) -> list[tuple[str, str]]:
    """Key intervals [from, to) of bit strings that hold every point of a box.

    A cell that the box meets in part is halved by the next bit of the interleaving, the
    largest cells first, until ``limit`` intervals are there; what is then still met in
    part is taken whole. Neighbouring intervals are joined. The union covers the box's
    points and, for boxes that end on edges of cells or a large limit, little else.
    """
    size = len(ranges)
    first = [_cell_of(x, *r, digits) for x, r in zip(low, ranges, strict=True)]
    last = [_cell_of(x, *r, digits) for x, r in zip(high, ranges, strict=True)]
    whole = (0, "", tuple((0, (1 << digits) - 1) for _ in ranges))
    open_cells, done = [whole], []
    while open_cells:
        depth, prefix, cell = heapq.heappop(open_cells)
        if any(b < x or a > y for (a, b), x, y in zip(cell, first, last)):
            continue
        inside = all(x <= a and b <= y for (a, b), x, y in zip(cell, first, last))
        if inside or depth == size * digits or len(open_cells) + len(done) >= limit - 1:
            done.append(prefix)
            continue
        dim = depth % size
        a, b = cell[dim]
        middle = (a + b) // 2
        for bit, half in (("0", (a, middle)), ("1", (middle + 1, b))):
            heapq.heappush(open_cells, (depth + 1, prefix + bit, (*cell[:dim], half, *cell[dim + 1 :])))
    # "2" follows all bit strings that begin with a prefix.
    joined: list[list[str]] = []
    for prefix in sorted(done):
        start = prefix.ljust(size * digits, "0")
        if joined and _next(joined[-1][1]) == start:
            joined[-1][1] = prefix.ljust(size * digits, "1")
        else:
            joined.append([start, prefix.ljust(size * digits, "1")])
    return [(start, end + "2") for start, end in joined]


def _next(bits: str) -> str:
    """The bit string after ``bits``, or an empty one after the last."""
    return f"{int(bits, 2) + 1:0{len(bits)}b}" if "0" in bits else ""


def _cell_of(x: Real, low: Real, high: Real, digits: int) -> int:
    """Cell number of one coordinate by the same halving as ``geohash_bits``."""
    low, high, cell = float(low), float(high), 0
    for _ in range(digits):
        middle = (low + high) / 2
        below = x < middle
        low, high = (low, middle) if below else (middle, high)
        cell = 2 * cell + (not below)
    return cell


def in_intervals(bits: Column, intervals: Sequence[tuple[str, str]]) -> Column:
    """True if a bit string lies in one of the intervals; prunes row groups of a sorted table."""
    hit = F.lit(False)
    for start, end in intervals:
        hit = hit | ((bits >= start) & (bits < end))
    return hit


def in_cell(bits: Column, prefix: Column | str) -> Column:
    """True if a bit string starts with a cell's bits, as a half-open key range.

    The range form prunes row groups of a table that is sorted by ``bits``.
    """
    low = F.lit(prefix) if isinstance(prefix, str) else prefix
    return (bits >= low) & (bits < F.concat(low, F.lit("2")))
