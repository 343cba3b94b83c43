"""Finding the renewal, or else the possible matches, of each alert certificate.

Strings are compared once per *distinct* string and certificates are looked up
by string afterwards, so the expensive part never sees the copies of a DN.

1. Equal strings need no scoring: alerts meet same-source, same-key candidates
   on the token-sorted DN itself (score 100, which nothing can beat).
2. The remaining alerts search their own source and keys for similar strings.
3. Alerts still without a renewal search the strings of all sources.

A search keeps, of each string's pairs, only those that can hold one of the rows asked for, before
anything is written: what is staged grows with the alerts. It goes ring by ring. Strings a character
apart come first; who finds enough there looks only for pairs that are at least as near. Where the
threshold is low, strict ones come first, and who finds enough leaves the search. Groups that are small on one
side, as most key groups are, need no rings: there all strings of similar lengths meet.

Key fields the alert leaves empty match anything. The candidate side is
therefore keyed once per combination of filled-in fields the alerts use (at
most 2^keys per source), which keeps every lookup an equi-join.

Only that table of combinations is broadcast. A plan here has several joins at once, so sides that
grow with the data are sorted and merged whatever their size, and the driver holds none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.config import NO_KEYS, Params, by_source, key_array
from certwatch.functions.scoring import rounded
from certwatch.functions.text import token_sorted_clean
from certwatch.operators.ranking import first_k, representatives
from certwatch.operators.similarity import by_classes, neighbours, pairs_by_length, signatures, similar_pairs, strangers, with_bags
from certwatch.staging import drop, measured_broadcasts, shuffled, stage

_POOL_FIELDS = ("cand_id", "distinguished_name", "days_to_expiration", "expiration_date",
                "csi_application_id", "sp_ssl_cm_status", "sp_name")

_GROUP = ["sp_name", "mask", "mkey"]
_RENEWAL_FIELDS = ["score", *[f for f in _POOL_FIELDS if f != "sp_name"]]
# comparing two strings is that many times less work than the keys of one
_PAIRS_PER_KEYS = 2_000
_POSSIBLE_TYPE = (
    "array<struct<cand_id:bigint,distinguished_name:string,days_to_expiration:bigint,expiration_date:timestamp,"
    "serial_number:string,similarity_score:double,csi_id:bigint,ssl_cm_status:string,source:string>>")


def extract_alerts(certs: DataFrame, cfg: Params) -> DataFrame:
    """Certificates of the processed sources expiring within the alert threshold."""
    return certs.where(
        F.col("sp_name").isin(*cfg.run_sources)
        & F.col("days_to_expiration").between(0, cfg.alert_days_threshold))


def match_keys(cfg: Params) -> Column:
    """The source's match fields as an array, empty values as NULL."""
    return by_source(cfg.specs, lambda s: key_array(s.match_keys), "sp_name", NO_KEYS)


def _alert_side(alerts: DataFrame, cfg: Params) -> DataFrame:
    keys = F.col("_keys")
    return (
        alerts.withColumn("_keys", match_keys(cfg))
        .withColumn("mask", F.transform(keys, lambda k: k.isNotNull()))
        .withColumn("mkey", F.transform(keys, lambda k: F.coalesce(k, F.lit(""))))
        .withColumn("own_serial", F.coalesce("serial_number_upper", F.lit("")))
        .withColumn("x", F.when(F.col("dn_clean") != "", token_sorted_clean(F.col("dn_clean"))))
        .drop("_keys")
    )


def renewal_pool(certs: DataFrame, cfg: Params) -> DataFrame:
    """Certificates with enough days left to be a renewal of something."""
    return certs.where(
        (F.col("days_to_expiration") >= cfg.renewal_min_days)
        & F.col("serial_number_upper").isNotNull()
        & (F.col("dn_clean") != "")
    ).withColumnRenamed("id", "cand_id").withColumn("y", token_sorted_clean(F.col("dn_clean"))) \
     .withColumn("serial", F.col("serial_number_upper"))


def keyed_pool(pool: DataFrame, masks: DataFrame, cfg: Params) -> DataFrame:
    """The pool once per key combination in use: (sp_name, mask, mkey) plus the pool columns.

    ``masks`` holds distinct (sp_name, mask); its size is bounded by the source
    specifications, not by the data.
    """
    keyed = (
        pool.withColumn("_keys", match_keys(cfg))
        .join(F.broadcast(masks), "sp_name")
        .where(F.expr("forall(zip_with(mask, _keys, (m, k) -> NOT m OR k IS NOT NULL), ok -> ok)"))
    )
    return keyed.withColumn(
        "mkey", F.expr("zip_with(mask, _keys, (m, k) -> if(m, k, ''))")).drop("_keys")


def _renewal_struct(best: Column) -> Column:
    return F.when(best.isNotNull(), F.struct(
        best["cand_id"].alias("cand_id"),
        F.coalesce(best["distinguished_name"], F.lit("")).alias("distinguished_name"),
        best["serial"].alias("serial_number"),
        F.coalesce(best["days_to_expiration"], F.lit(0)).alias("days_to_expiration"),
        best["expiration_date"].alias("expiration_date"),
        rounded(best["score"]).alias("similarity_score"),
        best["csi_application_id"].alias("csi_id"),
        best["sp_ssl_cm_status"].alias("ssl_cm_status"),
    ))


def _possible_struct(m: Column) -> Column:
    return F.struct(
        m["cand_id"].alias("cand_id"),
        F.coalesce(m["distinguished_name"], F.lit("")).alias("distinguished_name"),
        F.coalesce(m["days_to_expiration"], F.lit(0)).alias("days_to_expiration"),
        m["expiration_date"].alias("expiration_date"),
        m["serial"].alias("serial_number"),
        rounded(m["score"]).alias("similarity_score"),
        m["csi_application_id"].alias("csi_id"),
        m["sp_ssl_cm_status"].alias("ssl_cm_status"),
        m["sp_name"].alias("source"),
    )


def _order() -> list[Column]:
    # equal scores go to the lower id, so the result is the same on every run
    return [F.desc("score"), F.asc("cand_id")]


def equal_string_renewals(alerts: DataFrame, pool: DataFrame, cfg: Params) -> DataFrame:
    """Alerts with ``best``: the renewal whose token-sorted DN equals the alert's, or NULL."""
    masks = alerts.where("x IS NOT NULL").select("sp_name", "mask").distinct()
    wanted = alerts.where("x IS NOT NULL").select(*_GROUP, F.col("x").alias("y")).distinct()
    rows = (
        keyed_pool(pool, masks, cfg)
        .join(shuffled(wanted), [*_GROUP, "y"], "left_semi")
        .withColumn("score", F.lit(100.0))
    )
    reps = representatives(rows, [*_GROUP, "y"], 1, _RENEWAL_FIELDS, _order(), "found")
    reps = reps.withColumnRenamed("y", "x")
    return alerts.join(shuffled(reps), [*_GROUP, "x"], "left").withColumn(
        "best", F.try_element_at(first_k(F.col("found"), F.col("own_serial"), 1), F.lit(1))
    ).drop("found")


def _rings(threshold: float) -> list[float]:
    return [t for t in (90.0, 70.0, 40.0) if t > threshold] + [threshold]


def _nearest(links: DataFrame, heads: DataFrame, on: Sequence[str], group: Sequence[str], k: int) -> DataFrame:
    """The scored ``links`` (*group, *on, x, y, score) of each group whose string y can hold one of its first k rows.

    ``heads`` (*on, y, heads) has each string's first row and its first row of another serial. Whatever
    an alert's own serial, a string is in its order where the first of these with a different serial is; so the
    strings of the first rows, limited per serial as ``representatives`` does, are enough. An equal
    string may be left out by its DN, so it is kept besides.
    """
    rest = [c for c in links.columns if c not in group]
    rows = links.where("x <> y").join(shuffled(heads), [*on, "y"]).select(*links.columns, F.inline("heads"))
    best = representatives(rows, group, k, [*rest, "cand_id"], _order(), "best")
    return best.select(*group, F.inline("best")).select(*links.columns).distinct().unionByName(links.where("x = y"))


def _groups(xs: DataFrame, ys: DataFrame, on: Sequence[str]) -> tuple[DataFrame | None, bool, bool]:
    """The groups with ``small``, where comparing all is less work than making keys, and whether there are small and other ones.

    The table is None unless there are both.
    """
    count, nx, ny = F.count(F.lit(1)), F.col("nx"), F.col("ny")
    small = (nx * ny <= _PAIRS_PER_KEYS * (nx + ny)).alias("small")
    if not on:
        load = xs.agg(count.alias("nx"), ys.agg(count).scalar().alias("ny")).select(small).first()["small"]
        return None, load, not load
    groups = xs.groupBy(*on).agg(count.alias("nx")).join(shuffled(ys.groupBy(*on).agg(count.alias("ny"))), [*on]).select(*on, small)
    kinds = groups.agg(F.bool_or("small").alias("small"), F.bool_or(~F.col("small")).alias("other")).first()
    return (stage(groups, "groups"), True, True) if kinds["small"] and kinds["other"] else (None, bool(kinds["small"]), bool(kinds["other"]))


def _ranked(todo: DataFrame, group: Sequence[str], pool: DataFrame, on: Sequence[str], threshold: float,
            k: int, rank: Callable[[DataFrame], DataFrame], found: str, cfg: Params) -> DataFrame:
    """(*group, found): for each group of ``todo`` (*group, *on, x) its ranked candidates among ``pool`` (*on, y, serial, cand_id).

    ``rank`` makes them of scored links (todo's columns, y, score).
    """
    enough = 2 * k
    todo = stage(todo, "open")
    heads = stage(representatives(pool, [*on, "y"], 1, ["cand_id"], [F.asc("cand_id")], "heads"), "heads")
    ys = stage(with_bags(heads.select(*on, "y"), "y"), "strings")
    groups, some_small, some_large = _groups(todo.select(*on, "x").distinct(), ys, on)
    used = [todo, heads, ys, *([groups] if groups else [])]

    def part(df: DataFrame, small: bool) -> DataFrame:
        """The rows of the small or of the other groups."""
        return df if groups is None else df.join(shuffled(groups.where("small" if small else "NOT small")), [*on], "left_semi")

    def links_of(of: DataFrame, pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
        links = of.select(*dict.fromkeys([*group, *on, "x"])).join(shuffled(pairs), [*on, "x"])
        # what neighbours have found may be found again
        return stage(_nearest(links if known is None else links.unionByName(known).distinct(), heads, on, group, k), "links")

    def satisfied(rows: DataFrame) -> DataFrame:
        return rows.where(F.size(found) >= enough)

    def without(of: DataFrame, rows: DataFrame) -> DataFrame:
        used.append(stage(of.join(shuffled(satisfied(rows).select(*group)), [*group], "left_anti"), "todo"))
        return used[-1]

    def xs_of(of: DataFrame) -> DataFrame:
        return of.select(*on, "x").distinct()

    def ranked(links: DataFrame) -> DataFrame:
        out = stage(rank(links), "ring")
        drop(links)
        return out

    done = []
    if some_small:
        of = part(todo, True)
        pairs = pairs_by_length(xs_of(of), part(ys, True), threshold, cfg.length_ratio_min, cfg.hot_key_rows, on)
        done.append(ranked(links_of(of, pairs)))
    if some_large:
        todo, ys = part(todo, False), part(ys, False)
        near = links_of(todo, neighbours(xs_of(todo), ys, threshold, cfg.length_ratio_min, on))
        rows = stage(rank(near), "ring")
        bound = satisfied(rows).select(*group, F.element_at(found, -1)["score"].alias("_least"))
        # a string may be of several groups, each of which must have enough
        xs = stage(todo.join(shuffled(bound), [*group], "left").groupBy(*on, "x").agg(
            F.min(F.coalesce("_least", F.lit(0.0))).alias("least")), "bounds")
        used += [near, rows, xs]

        def ring(of: DataFrame, xs: DataFrame, t: float, more: DataFrame | None = None) -> DataFrame:
            sig = signatures(ys, t)
            pairs = similar_pairs(xs, sig, t, cfg.length_ratio_min, cfg.hot_key_rows, on, beyond=by_classes(t))
            # those of whom no candidate of this ring can be missing
            known = near.join(shuffled(of.select(*group).distinct()), [*group], "left_semi").where(F.col("score") >= t)
            out = ranked(links_of(of, pairs if more is None else pairs.unionByName(more), known))
            if sig is not ys:
                drop(sig)
            return out

        for t in _rings(threshold):
            rows = ring(todo, xs, t)
            if t > threshold:
                done.append(satisfied(rows))
                todo = without(todo, rows)
                xs = xs_of(todo)
            elif t > 0:
                done.append(rows)
            else:
                # who has enough is ahead of all that scores 0
                done.append(satisfied(rows))
                rest = without(todo, rows)
                done.append(ring(rest, xs_of(rest), t, strangers(xs_of(rest), ys.select(*on, "y"), cfg.length_ratio_min, on)))
    drop(*used)
    if not done:
        return rank(stage(todo.select(*dict.fromkeys([*group, *on, "x"]), F.lit("").alias("y"), F.lit(0.0).alias("score")).limit(0), "links"))
    return reduce(DataFrame.unionByName, done)


def scored_renewals(rest: DataFrame, pool: DataFrame, cfg: Params) -> DataFrame:
    """(sp_name, mask, mkey, x, found): ranked renewal candidates of the groups in ``rest``."""
    groups = rest.select(*_GROUP, "x").distinct()
    masks = rest.select("sp_name", "mask").distinct()
    # only the key groups an open alert belongs to can matter
    keyed = keyed_pool(pool, masks, cfg).join(shuffled(rest.select(*_GROUP).distinct()), _GROUP, "left_semi")

    def rank(links: DataFrame) -> DataFrame:
        rows = keyed.join(shuffled(links.select(*_GROUP, "y").distinct()), [*_GROUP, "y"], "left_semi")
        # within one string all scores are equal, so two serials are enough before fanning out
        per_string = representatives(rows, [*_GROUP, "y"], 1, _RENEWAL_FIELDS[1:], [F.asc("cand_id")], "cands")
        flat = links.join(shuffled(per_string), [*_GROUP, "y"]).select(*_GROUP, "x", "score", F.inline("cands"))
        return representatives(flat, [*_GROUP, "x"], 1, _RENEWAL_FIELDS, _order(), "found")

    return _ranked(groups, [*_GROUP, "x"], keyed.select(*_GROUP, "y", "serial", "cand_id"), _GROUP,
                   cfg.renewal_score_threshold, 1, rank, "found", cfg)


def scored_possibles(rest: DataFrame, pool: DataFrame, cfg: Params) -> DataFrame:
    """(dn_clean, candidates): ranked cross-source candidates per distinct alert DN."""
    k = max(1, cfg.possible_k)

    def rank(links: DataFrame) -> DataFrame:
        rows = pool.join(shuffled(links.select("y").distinct()), "y", "left_semi").withColumnRenamed("dn_clean", "cand_dn")
        per_string = representatives(rows, ["y", "cand_dn"], k, _POOL_FIELDS, [F.asc("cand_id")], "cands")
        flat = links.join(shuffled(per_string), "y")
        if cfg.exclude_same_dn:
            flat = flat.where(F.col("cand_dn") != F.col("dn_clean"))
        flat = flat.select("dn_clean", "score", F.inline("cands"))
        return representatives(flat, ["dn_clean"], k, ["score", *_POOL_FIELDS], _order(), "candidates")

    return _ranked(rest.select("dn_clean", "x").distinct(), ["dn_clean"], pool.select("y", "serial", "cand_id"), (),
                   cfg.possible_match_score_threshold, k, rank, "candidates", cfg)


def with_renewals(certs: DataFrame, cfg: Params) -> DataFrame:
    """Every alert certificate with ``renewal`` (struct or NULL), its token-sorted DN and serial; staged."""
    alerts = _alert_side(extract_alerts(certs, cfg), cfg)
    pool = renewal_pool(certs, cfg)
    with measured_broadcasts(certs.sparkSession):
        first = stage(equal_string_renewals(alerts, pool, cfg), "alerts")
        renewals = scored_renewals(first.where("best IS NULL AND x IS NOT NULL"), pool, cfg)
        second = F.try_element_at(first_k(F.col("found"), F.col("own_serial"), 1), F.lit(1))
        return stage(
            first.join(shuffled(renewals), [*_GROUP, "x"], "left")
            .withColumn("renewal", F.coalesce(_renewal_struct(F.col("best")), _renewal_struct(second)))
            .select(*certs.columns, "own_serial", "x", "renewal"),
            "matched")


def match_outcomes(certs: DataFrame, cfg: Params) -> DataFrame:
    """Every alert certificate with ``renewal`` (struct or NULL) and ``possible_matches`` (array); staged.

    A renewal and possible matches never occur together.
    """
    pool, own = renewal_pool(certs, cfg), F.col("own_serial")
    matched = with_renewals(certs, cfg)
    listed = F.transform(first_k(F.col("candidates"), own, cfg.possible_k), _possible_struct)
    has_list = F.col("renewal").isNull() & F.col("candidates").isNotNull()
    with measured_broadcasts(certs.sparkSession):
        possibles = scored_possibles(matched.where("renewal IS NULL AND x IS NOT NULL"), pool, cfg)
        return stage(
            matched.join(shuffled(possibles), "dn_clean", "left")
            .withColumn("possible_matches", F.when(has_list, listed).otherwise(F.array().cast(_POSSIBLE_TYPE)))
            .select(*certs.columns, "renewal", "possible_matches"),
            "outcomes")


def find_renewals(certs: DataFrame, cfg: Params) -> DataFrame:
    """(id, renewal.*) of the alerts that have one."""
    return with_renewals(certs, cfg).where("renewal IS NOT NULL").select(
        "id", "sp_name", "days_to_expiration", "renewal")


def find_possible_matches(certs: DataFrame, cfg: Params) -> DataFrame:
    """One row per (alert, rank) of the possible matches."""
    return match_outcomes(certs, cfg).select(
        "id", "sp_name", F.posexplode("possible_matches").alias("pos", "match")
    ).select("id", "sp_name", (F.col("pos") + 1).alias("rank"), "match")


def renewal_candidate_counts(certs: DataFrame, cfg: Params) -> DataFrame:
    """(id, n_candidates): how many certificates reach the scorer for each alert.

    Counted from (group, length) histograms; the pairs themselves are never
    formed. The alert's own serial is subtracted afterwards. An alert with an
    empty DN has no candidates.
    """
    alerts = _alert_side(extract_alerts(certs, cfg), cfg).select(
        "id", *_GROUP, "own_serial", F.length("x").alias("n"))
    masks = alerts.where("n IS NOT NULL").select("sp_name", "mask").distinct()
    by_serial = keyed_pool(renewal_pool(certs, cfg), masks, cfg).groupBy(
        *_GROUP, F.length("y").alias("cn"), "serial").agg(F.count(F.lit(1)).alias("c"))
    by_length = by_serial.groupBy(*_GROUP, "cn").agg(F.sum("c").alias("c"))
    gate = F.least("n", "cn") / F.greatest("n", "cn") >= cfg.length_ratio_min
    shapes = alerts.select(*_GROUP, "n").distinct()
    total = (
        shapes.join(by_length, _GROUP).where(gate)
        .groupBy(*_GROUP, "n").agg(F.sum("c").alias("total"))
    )
    own = (
        alerts.select(*_GROUP, "n", "own_serial").distinct()
        .join(by_serial.withColumnRenamed("serial", "own_serial"), [*_GROUP, "own_serial"]).where(gate)
        .groupBy(*_GROUP, "n", "own_serial").agg(F.sum("c").alias("own"))
    )
    return (
        alerts.join(total, [*_GROUP, "n"], "left").join(own, [*_GROUP, "n", "own_serial"], "left")
        .select("id", "sp_name",
                (F.coalesce("total", F.lit(0)) - F.coalesce("own", F.lit(0))).alias("n_candidates"))
    )
