"""Plain versions of the pipeline's filtering stages."""

from test_similarity import plain_components, plain_fingerprint, plain_shingles

from wattsmith.llm.quality_rules import measure


def rules_kept(rows):
    return [r for r in rows if measure(r[1])[-1]]


def one_of_each(rows):
    rows = sorted(rows)
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    return [r for i, r in enumerate(rows) if roots[i] == i]


def leak_free(rows, items):
    shingles = [plain_shingles(t) for t in items]
    return [r for r in rows if not any(s and len(s & plain_shingles(r[1])) >= 0.8 * len(s) for s in shingles)]
