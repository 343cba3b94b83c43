"""Matching against a row-by-row brute force, on skewed certificates."""

import random
from dataclasses import replace

import pytest
from test_scoring import lcs_table

from certwatch.operators.matching import match_outcomes, renewal_candidate_counts
from certwatch.sources.certificates import to_snapshot

FIELDS = ("sp_ssg_domain", "sp_microservice_name", "sp_internal_ssg_domain", "sp_evolven_host", "sp_evolven_path")


def certificates(seed: int) -> list[dict]:
    """A third of the rows share one source, key and DN; serials repeat; keys go missing."""
    rng = random.Random(seed)
    names = [f"{rng.choice('abcd')}{rng.randrange(10)}-gateway-{rng.randrange(300)}" for _ in range(25)]
    names += [n + "x" for n in names[:8]] + [f"CN={n.split('-')[2]}.{n.split('-')[0]}.gateway" for n in names[:6]]
    rows = []
    for i in range(240):
        hot = i % 3 == 0
        rows.append({
            "id": 1000 - i if i % 7 == 0 else 2000 + i,
            "distinguished_name": names[0] if hot else rng.choice([*names, "prod.com"]),
            "days_to_expiration": rng.choice([0, 3, 7, 8, 89, 90, 200, 400]),
            "sp_name": "SSG" if hot else rng.choice(["SSG", "AKAMAI", "Evolven", "APIGEE", "Other"]),
            "sp_serial_number": rng.choice([f"s{rng.randrange(12)}", f"S{i}", None, "dup", "dup"]),
            "sp_ssg_domain": "d0" if hot else rng.choice(["d0", "d1", None]),
            "sp_microservice_name": "m0" if hot else rng.choice(["m0", "m1"]),
            "sp_internal_ssg_domain": rng.choice(["i0", None]),
            "sp_evolven_host": rng.choice(["h0", "h1", None]),
            "sp_evolven_path": "p",
        })
    return rows


KEYS = {"SSG": FIELDS[:3], "Evolven": FIELDS[3:], "APIGEE": ("sp_evolven_host", "sp_evolven_path", "sp_ssg_domain"),
        "AKAMAI": ("sp_serial_number",)}


def brute_force(rows, cfg):
    out = {}
    for a in rows:
        if not (a["sp_name"] in cfg.active_sources and 0 <= a["days_to_expiration"] <= 7):
            continue
        renewals, possibles = [], []
        for c in rows:
            if c["days_to_expiration"] < 90 or not c["serial"] or c["serial"] == (a["serial"] or ""):
                continue
            if not a["clean"] or not c["clean"]:
                continue
            x, y = (" ".join(sorted(r["clean"].split())) for r in (a, c))
            total, lcs = len(x) + len(y), lcs_table(x, y)
            if min(len(x), len(y)) / max(len(x), len(y)) < cfg.length_ratio_min:
                continue
            item = (-2 * lcs / total, c["id"])
            same = c["sp_name"] == a["sp_name"] and all(
                a[k] is None or a[k] == c[k] for k in KEYS[a["sp_name"]])
            if same and 200 * lcs >= cfg.renewal_score_threshold * total:
                renewals.append(item)
            if (c["clean"] != a["clean"] or not cfg.exclude_same_dn) \
                    and 200 * lcs >= cfg.possible_match_score_threshold * total:
                possibles.append(item)
        best = min(renewals)[1] if renewals else None
        out[a["id"]] = (best, [] if best else [i for _, i in sorted(possibles)[:cfg.possible_k]])
    return out


@pytest.fixture(scope="module")
def data(spark, cfg):
    rows = certificates(7)
    schema = ", ".join(f"{k} {'bigint' if k in ('id', 'days_to_expiration') else 'string'}" for k in rows[0])
    certs = to_snapshot(spark.createDataFrame([tuple(r.values()) for r in rows], schema), cfg)
    clean = {r["id"]: (r["dn_clean"], r["serial_number_upper"]) for r in certs.collect()}
    for r in rows:
        r["clean"], r["serial"] = clean[r["id"]]
    return certs, rows


@pytest.mark.parametrize("changes", [
    {},
    {"exclude_same_dn": False},
    {"renewal_score_threshold": 95.0, "possible_match_score_threshold": 75.0},
    {"max_possible_display": 1, "renewal_score_threshold": 100.0},
    {"max_possible_candidates": 0, "length_ratio_min": 0.95},
    {"possible_match_score_threshold": 60.0, "max_possible_display": 6, "hot_key_rows": 5},
    {"possible_match_score_threshold": 70.0, "renewal_score_threshold": 70.0},
    {"possible_match_score_threshold": 0.0, "renewal_score_threshold": 0.0},
    {"possible_match_score_threshold": 0.0, "renewal_score_threshold": 0.0, "length_ratio_min": 0.0, "max_possible_display": 6},
])
def test_equals_brute_force(data, cfg, changes):
    certs, rows = data
    cfg = replace(cfg, **changes)
    want = brute_force(rows, cfg)
    got = {
        r["id"]: (r["renewal"] and r["renewal"]["cand_id"], [m["cand_id"] for m in r["possible_matches"]])
        for r in match_outcomes(certs, cfg).collect()
    }
    assert got == want
    assert all(not (renewal and possible) for renewal, possible in got.values())


def test_requested_sources_narrow_the_alerts(data, cfg):
    certs, _ = data
    only = replace(cfg, requested_sources=("Evolven", "Nowhere"))
    assert {r["sp_name"] for r in match_outcomes(certs, only).select("sp_name").collect()} == {"Evolven"}


def test_candidate_counts(data, cfg):
    certs, rows = data
    got = {r["id"]: r["n_candidates"] for r in renewal_candidate_counts(certs, cfg).collect()}
    for a in rows:
        if a["id"] in got:
            want = sum(
                1 for c in rows
                if c["days_to_expiration"] >= 90 and c["serial"] and c["clean"] and c["serial"] != (a["serial"] or "")
                and c["sp_name"] == a["sp_name"]
                and all(a[k] is None or a[k] == c[k] for k in KEYS[a["sp_name"]])
                and min(len(a["clean"]), len(c["clean"])) / max(len(a["clean"]), len(c["clean"])) >= 0.6)
            assert got[a["id"]] == want


def test_plan_has_no_nested_loop(data, cfg):
    plan = match_outcomes(data[0], cfg)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_renewals_never_search_possible_matches(spark, monkeypatch):
    from certwatch.checks.queries import QUERIES
    from certwatch.operators import matching

    monkeypatch.setattr(matching, "scored_possibles", lambda *_: (_ for _ in ()).throw(AssertionError("possible matches searched")))
    QUERIES["renewals"](spark, "/root/testdata/sf0.001").count()


@pytest.mark.parametrize("threshold", [90.0, 60.0])
def test_numbered_hosts_list_no_pairs(spark, cfg, monkeypatch, threshold):
    """Names that differ in a number all resemble each other; what is staged grows with the alerts."""
    from certwatch.operators import matching

    staged, kept = [], matching.stage

    def counted(df, label):
        out = kept(df, label)
        staged[-1][label] = max(staged[-1].get(label, 0), out.count())
        return out

    monkeypatch.setattr(matching, "stage", counted)
    cfg = replace(cfg, renewal_score_threshold=threshold, possible_match_score_threshold=threshold)
    for n in (100, 200, 400):
        rows = [{"id": i, "distinguished_name": f"CN=node-{i * 7 % n:04d}.grid.site", "sp_name": "SSG" if i % 2 else "AKAMAI",
                 "days_to_expiration": 5 if i % 4 == 0 else 200, "sp_serial_number": f"s{i}", "sp_ssg_domain": f"d{i % 2}"} for i in range(n)]
        schema = ", ".join(f"{k} {'bigint' if k in ('id', 'days_to_expiration') else 'string'}" for k in rows[0])
        certs = to_snapshot(spark.createDataFrame([tuple(r.values()) for r in rows], schema), cfg)
        clean = {r["id"]: (r["dn_clean"], r["serial_number_upper"]) for r in certs.collect()}
        for r in rows:
            r["clean"], r["serial"] = clean[r["id"]]
        staged.append({})
        got = {r["id"]: (r["renewal"] and r["renewal"]["cand_id"], [m["cand_id"] for m in r["possible_matches"]])
               for r in match_outcomes(certs, cfg).collect()}
        if n < 400:
            want = brute_force([{**{k: None for k in FIELDS}, **r} for r in rows], cfg)
            assert got == want
    assert staged[0]["links"] > 0
    for before, after in zip(staged, staged[1:]):
        assert after["links"] <= 2.2 * before["links"] + 20


@pytest.mark.parametrize("pairs_per_keys", [0, 5])
def test_groups_of_any_size_equal_brute_force(data, cfg, monkeypatch, pairs_per_keys):
    """Groups are searched by keys, or some of them by lengths."""
    from certwatch.operators import matching

    monkeypatch.setattr(matching, "_PAIRS_PER_KEYS", pairs_per_keys)
    certs, rows = data
    cfg = replace(cfg, renewal_score_threshold=85.0, possible_match_score_threshold=85.0)
    got = {
        r["id"]: (r["renewal"] and r["renewal"]["cand_id"], [m["cand_id"] for m in r["possible_matches"]])
        for r in match_outcomes(certs, cfg).collect()
    }
    assert got == brute_force(rows, cfg)
