"""What building an inverted file holds at a time."""

import tracemalloc

import numpy as np

from kinweave.functions.vectors import distances, nearest_centre
from kinweave.operators.inverted import kmeans


def test_kmeans_never_holds_the_distances_of_all_points_to_all_centres():
    points = np.random.default_rng(5).standard_normal((20_000, 8))
    tracemalloc.start()
    centres = kmeans(points, 400, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(centres) == 400
    # All distances are 64 MB, and were held several times over.
    assert peak < 40 << 20


def test_nearest_centre_by_slices():
    rng = np.random.default_rng(6)
    points, centres = rng.standard_normal((50, 4)), rng.standard_normal((7, 4))
    cell, gap = nearest_centre(points, centres, cells=20)
    assert (cell == distances(points, centres).argmin(axis=1)).all()
    assert np.allclose(gap, distances(points, centres).min(axis=1))
