"""The reference tables hold the reviewed policy: counts, and values written out here by hand."""

from collections import Counter

from cohortgram import reference as ref


def test_counts():
    pairs, exclusions, labels = ref.pair_rows(), ref.exclusion_rows(), ref.label_rows()
    assert Counter((row[4], row[5]) for row in pairs) == {(1, "reviewed"): 311, (0, "proposed"): 11}
    assert len(exclusions) == len({row[:4] for row in exclusions}) == 61
    assert sum(row[1:3] == ("*", "*") for row in exclusions) == 33
    assert len(labels) == len({row[0] for row in labels}) == 41
    assert sum(row[6] is not None for row in labels) == 26 and all(row[6] for row in exclusions)
    assert len(ref.group_rows()) == 20


def test_review_basis_as_it_stands():
    basis = Counter(row[5] for row in ref.exclusion_rows())
    assert basis["Project owner review 2026-10-13"] == 28
    assert basis["IDSA 2026"] == 12 and basis["IDSA AMR Guidance 2026"] == 10
    assert basis["CLSI AST Case Study (2019)"] == basis["CLSI AST News Update (May 2025)"] == 1
    assert basis["M. morganii expected phenotype / literature review"] == 5


def test_natural_order():
    keys = [row[:4] for row in ref.exclusion_rows()]
    assert keys == sorted(keys)
