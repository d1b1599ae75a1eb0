"""The catalogue loads, and its invalid / unusual rows are reported up front."""

from arealens.plans import catalogue as C


def test_catalogue_rows_become_specs():
    errs = C.validate()
    # the only run that cannot execute as written: a crude rate without its multiplier (quirk Q11)
    assert list(errs) == ["school_exclusion/second/13016"]
    assert len(C.entries()) > 100


def test_epop_total_mismatch_is_reported():
    warn = [e.to_spec(geography="all").epop_warning() for e in C.entries()
            if e.measure == "stdrate" and e.stage == "second" and e.yearstart is not None]
    # e.g. a 16+ total used with all-age weights (quirk Q13) or an age-restricted population
    assert any(w for w in warn)


def test_a_row_without_geography_is_an_error():
    import pytest

    row = next(e for e in C.entries() if e.stage == "second" and e.geography is None)
    with pytest.raises(ValueError, match="geography"):
        row.to_spec(2002, 2019)
    assert row.to_spec(2002, 2019, "council").geography == "council"
    assert all(e.to_spec(2002, 2019).geography == "datazone11" for e in C.entries() if e.stage == "deprivation")
