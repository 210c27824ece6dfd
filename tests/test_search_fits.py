"""How many fits of a search run at a time."""

import pytest

from tenura.operators import models


@pytest.mark.parametrize(("rows", "cores", "fits"), [(8_000, 12, 12), (8_000, 1, 2), (120_000, 12, 4), (4_000_000, 12, 2), (0, 400, 16)])
def test_small_fits_fill_the_cores(rows, cores, fits):
    assert models.concurrent_fits(rows, cores) == fits
