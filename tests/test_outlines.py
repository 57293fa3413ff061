"""Outlines of regions against plain loops over small rasters."""

import random

import pytest

from brackwater.operators import outlines, select

PINCHED = ["#####", "#.###", "##.##", "#####", "##..#"]  # two holes that meet at a corner, and a notch
SPIRAL = ["#######", "......#", "#####.#", "#...#.#", "#.###.#", "#.....#", "#######"]


def noise(seed, n=12):
    r = random.Random(seed)
    return ["".join(r.choice("##.") for _ in range(n)) for _ in range(n)]


def frame(spark, lines):
    rows = [(r, c, v) for r, line in enumerate(lines) for c, v in enumerate(line)]
    return spark.createDataFrame(rows + rows[:3], "row int, col int, value string")  # the first pixels twice


def reachable(cells, steps):
    """Sets of cells that steps connect."""
    left, out = set(cells), []
    while left:
        todo, own = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            own.add((r, c))
            near = {(r + a, c + b) for a, b in steps} & left
            left -= near
            todo += near
        out.append(own)
    return out


FOUR = [(0, 1), (1, 0), (0, -1), (-1, 0)]
EIGHT = [*FOUR, (1, 1), (1, -1), (-1, 1), (-1, -1)]


@pytest.mark.parametrize("lines", [PINCHED, SPIRAL, ["#"], noise(1), noise(2)], ids=["pinched", "spiral", "one", "noise", "more noise"])
def test_rings_equal_plain_loops(spark, lines):
    pixels = {(r, c): v for r, line in enumerate(lines) for c, v in enumerate(line)}
    regions = [own for v in set(pixels.values()) for own in reachable([p for p, w in pixels.items() if w == v], FOUR)]
    corners = outlines.ring_corners(select.regions(frame(spark, lines)).distinct()).cache()
    rows = corners.collect()
    found = {}
    for r in rows:
        found.setdefault(r.region, {}).setdefault(r.ring, []).append(r)
    by_ring = {r.ring: r for r in outlines.rings(corners).collect()}
    assert len(found) == len(regions)
    for own in regions:
        row, col = min(own)
        mine = found[row * 2**31 + col]
        for ring, places in mine.items():
            places.sort(key=lambda r: r.position)
            assert [r.position for r in places] == list(range(len(places)))
            at = [(r.x, r.y) for r in places]
            assert len(set(at)) == len(at)  # simple: no corner twice
            for a, b in zip(places, [*places[1:], places[0]], strict=True):
                assert (a.x2, a.y2) == (b.x, b.y) and (a.x == b.x) != (a.y == b.y)
        area = sum(by_ring[ring].area for ring in mine)
        assert area == len(own)
        assert sum(by_ring[ring].perimeter for ring in mine) == sum((r + a, c + b) not in own for r, c in own for a, b in FOUR)
        assert sum(not by_ring[ring].hole for ring in mine) == 1
        # Holes that touch at a corner are one for the eight directions, and two rings.
        around = {(r, c) for r in range(-1, len(lines) + 1) for c in range(-1, len(lines[0]) + 1)} - own
        assert sum(by_ring[ring].hole for ring in mine) == len(reachable(around, EIGHT)) - 1 + pinches(own)


def pinches(own):
    """Corners where pixels of a region meet only across: each parts the background on both sides, which eight directions join."""
    return sum((r + 1, c + b) in own and (r, c + b) not in own and (r + 1, c) not in own for r, c in own for b in (1, -1))


def test_wkt(spark):
    ring = select.regions(frame(spark, ["###", "#.#", "###"])).distinct()
    got = {r.region: r.wkt for r in outlines.outline_wkt(outlines.ring_corners(ring), origin=(10.0, 20.0)).collect()}
    assert got[0] == "POLYGON ((10.0 20.0, 13.0 20.0, 13.0 17.0, 10.0 17.0, 10.0 20.0), (11.0 19.0, 11.0 18.0, 12.0 18.0, 12.0 19.0, 11.0 19.0))"
    assert got[2**31 + 1] == "POLYGON ((11.0 19.0, 12.0 19.0, 12.0 18.0, 11.0 18.0, 11.0 19.0))"


def test_pixels_without_place_and_no_pixels(spark):
    df = spark.createDataFrame([(0, 0, 7), (None, 1, 7), (0, None, 7), (0, 1, None)], "row int, col int, region long")
    assert [tuple(r) for r in outlines.rings(outlines.ring_corners(df)).select("region", "hole", "corners", "perimeter", "area").collect()] == [(7, False, 4, 4, 1)]
    assert outlines.rings(outlines.ring_corners(df.where("false"))).count() == 0
