"""Merge of form submissions into the lead table.

A submission goes to the lead with its e-mail, else to the lead with its phone,
else to the best lead with the same company or name that scores at least 0.90,
else it becomes a new lead. The exact lookups see the table as it was before the
batch; the score sees what earlier submissions of the batch changed or added.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.identity import SCORING_FIELDS, phone_tail, scoring_fields, token_string
from leadloom.functions.similarity import score_pairs
from leadloom.functions.text import present
from leadloom.operators.numbering import number_rows
from leadloom.operators.upsert import max_value
from leadloom.schema import LEAD_COLUMNS, MERGE_CONFIDENCE, PHONE_TAIL
from leadloom.sources.scratch import FEW, shuffled, sized, written

# stretches a group of copies is ranked in before the ranks are put together
_SALTS = 64


def _exact_keys(df: DataFrame, row: str) -> DataFrame:
    """``(row, kind, value)``: e-mail (kind 1) and phone (kind 2) where present."""
    keys = [
        F.when(present(F.col(c)).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")))
        for kind, c in ((1, "email_normalized"), (2, "phone_normalized"))
    ]
    return df.select(row, F.inline(F.array_compact(F.array(*keys))))


def match_exact(rows: DataFrame, leads: DataFrame) -> DataFrame:
    """``(seq, kind, id)``: the lead with the row's e-mail, else its phone.

    Of several leads the smallest id is taken, with partial minima before the
    shuffle, so a value that many leads share costs no more than others. Rows
    without e-mail and phone do not take part in the join.
    """
    keys = _exact_keys(rows, "seq")
    first = _exact_keys(leads, "id").groupBy("kind", "value").agg(F.min("id").alias("id"))
    wanted = first.join(shuffled(keys.select("kind", "value").distinct()), ["kind", "value"], "left_semi")
    hits = keys.join(shuffled(wanted), ["kind", "value"])
    return hits.groupBy("seq").agg(F.min(F.struct("kind", "id")).alias("hit")).select("seq", "hit.*")


_ALIKE = [c for c in SCORING_FIELDS if c != "id"]


def _fuzzy_keys() -> Column:
    """Values by which a row can score, as far as it has them; see ``_fuzzy_keyed``."""
    phone = F.col("phone_normalized")
    usable = (F.char_length(phone) >= PHONE_TAIL) & present(F.col("email_normalized")).isNotNull()
    tail = F.right(phone, F.lit(PHONE_TAIL))
    keys = [
        F.when(usable & present(F.col(c)).isNotNull(), F.concat_ws("|", tail, F.lit(c), F.col(c)))
        for c in ("company_normalized", "name_normalized")
    ]
    return F.array_compact(F.array(*keys))


def lookup_keys(df: DataFrame, row: str) -> DataFrame:
    """``(kind, value, row)``: every value by which a submission can reach a stored lead, or a lead be reached.

    Kinds are e-mail (1), phone (2), and the end of the phone with company or name
    (3). A lead that shares none with any row of a batch plays no part in its merge.
    """
    near = df.select(row, F.explode(_fuzzy_keys()).alias("value")).select(row, F.lit(3).alias("kind"), "value")
    return _exact_keys(df, row).unionByName(near).select("kind", "value", row)


def _fuzzy_keyed(df: DataFrame, side: str) -> DataFrame:
    """Scoring fields prefixed with ``side``, once per ``key`` of the row.

    The keys are the last digits of the phone with the company, and with the
    name. Without an equal e-mail or phone, a score of 0.90 takes a phone that
    agrees in its last eight digits (or at most 0.80 is left) and an e-mail that
    is at least similar. So these keys lose no match, and unlike the company or
    the name alone they are shared by few.
    """
    fields = scoring_fields(df, _fuzzy_keys().alias("keys"))
    # no text holds a NUL, so it can stand for a missing country in comparisons
    fields = fields.withColumn("country_key", F.coalesce("country_key", F.lit("\0")))
    return fields.select(*[F.col(c).alias(f"{side}_{c}") for c in SCORING_FIELDS], F.explode("keys").alias("key"))


def _candidates(kinds: DataFrame, leads: DataFrame, hit: DataFrame | None = None) -> DataFrame:
    """Leads that share a fuzzy key with some row, per key, with ``first``.

    ``kinds`` are those of the rows, with ``n``, how many rows they have. ``hit (id)`` are leads that exact matches change; each of them stands for
    itself. Other leads that are alike in every scored field are a group: among
    those still alike the smallest id always wins. Only rows that share one of the
    group's keys can change its leads, and each changes at most one. So, with R the
    rows of all keys of the group together, no lead after the R smallest ids can
    ever be reached, and those are left out; that never changes a result. ``first``
    is the smallest id of the group. Places are given within salted parts first, so
    that no task sees all of many copies.
    """
    wanted = kinds.select("n", F.explode(_fuzzy_keys()).alias("key")).groupBy("key").agg(F.sum("n").alias("rows"))
    found = _fuzzy_keyed(leads, "b").join(shuffled(wanted), "key")
    if hit is not None:
        found = found.join(hit.select(F.col("id").alias("b_id"), F.col("id").alias("_own")), "b_id", "left")
    else:
        found = found.withColumn("_own", F.lit(None).cast("bigint"))
    found = found.withColumn("_own", F.coalesce("_own", F.lit(0).cast("bigint")))
    same = [*[f"b_{c}" for c in _ALIKE], "_own"]
    reach = found.select(*same, "key", "rows").distinct().groupBy(*same).agg(F.sum("rows").alias("_reach"))
    alike = ["key", *same]
    found = found.join(shuffled(reach), same).withColumn("_salt", F.pmod(F.xxhash64("b_id"), F.lit(_SALTS)))
    for group in ([*alike, "_salt"], alike):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("b_id"))
        found = found.withColumn("_place", place).where(F.col("_place") <= F.col("_reach"))
    first = F.min("b_id").over(Window.partitionBy(*alike))
    return found.withColumn("first", first).drop("_salt", "_place", "_reach", "_own", "rows")


def fuzzy_scores(fields: DataFrame, kinds: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(a_kind, id, score)`` of kinds of rows and candidate leads at or above 0.90.

    ``fields`` are the kinds' scoring fields. Leads that are alike are scored once.
    """
    keyed = kinds.select("a_kind", F.explode(_fuzzy_keys()).alias("key")).join(shuffled(fields), "a_kind")
    pairs = keyed.join(shuffled(candidates.where("b_id = first")), "key")
    absent = {c: F.nullif(F.col(c), F.lit("\0")) for c in ("a_country_key", "b_country_key")}
    scored = score_pairs(pairs.withColumns(absent), MERGE_CONFIDENCE, ["a_kind", "b_id"])
    return scored.select("a_kind", F.col("b_id").alias("id"), "score").distinct()


def match_fuzzy(rows: DataFrame, leads: DataFrame) -> DataFrame:
    """``(seq, id, score)``: best lead at or above 0.90 with the same company or name.

    ``rows`` are submissions without an exact match; each is scored against the
    table as it is. Of equal scores the smallest id wins.
    """
    named, kinds, fields = _row_kinds(rows)
    found = fuzzy_scores(fields, kinds, _candidates(kinds, leads))
    best = F.max_by("id", F.struct("score", -F.col("id")))
    return named.join(found.groupBy("a_kind").agg(best.alias("id"), F.max("score").alias("score")), "a_kind").drop("a_kind")


# what a match looks at; updates change all but the last two
_CHANGED = ["first_name", "last_name", "email_normalized", "phone_normalized", "country"]
_STATE = [*_CHANGED, "name_normalized", "company_normalized"]
# what a submission is matched by; empty and missing are the same
_PROBE = [c for c in _STATE if c not in ("first_name", "last_name")]

# sorted words of name and company, which a lead keeps from its beginning too
_WORDS = {"name_words": "name_normalized", "company_words": "company_normalized"}
# two numbers that stand for the fields of a version of a lead
_MARK = ["mark", "mark2"]

# submissions that one task looks at when it drops those that repeat the one before
_STRETCH = 1 << 16


class _Patched:
    """Rows of which those with some ``key`` are replaced again and again.

    What replaces others is kept apart, each time with its keys, and put together
    with what came just before it unless that is much more. So a small change does
    not write the whole table anew, and few parts are read.
    """

    def __init__(self, key: str, label: str, rows: DataFrame):
        self.key, self.label = key, label
        self.parts = [(None, written(rows, label), 1 << 62)]

    def _joined(self, start: int) -> DataFrame:
        """The rows of all parts from ``start`` on that no later part replaces."""
        rows = self.parts[start][1]
        for keys, newer, _ in self.parts[start + 1 :]:
            rows = rows.join(F.broadcast(keys), self.key, "left_anti").unionByName(newer)
        return rows

    def rows(self) -> DataFrame:
        return self._joined(0)

    def replace(self, keys: DataFrame, rows: DataFrame) -> None:
        """``rows`` come in place of all that have one of ``keys``; both were written, each key is there once."""
        n = keys.count()
        if n > FEW:
            kept = self._joined(0).join(keys, self.key, "left_anti")
            self.parts = [(None, written(kept.unionByName(rows), self.label), 1 << 62)]
            return
        self.parts.append((keys, rows, n))
        start = len(self.parts) - 1
        while self.parts[start - 1][2] <= 4 * sum(n for *_, n in self.parts[start:]):
            start -= 1
        if start < len(self.parts) - 1:
            every = reduce(DataFrame.unionByName, [keys for keys, *_ in self.parts[start:]]).distinct()
            every = written(every, "gone")
            self.parts[start:] = [(every, written(self._joined(start), self.label), every.count())]
            if self.parts[-1][2] > FEW:
                self.parts = [(None, written(self._joined(0), self.label), 1 << 62)]


def _near_keys(phone: Column) -> Column:
    """Values of which a submission and a lead that matches it share one: e-mail or ``phone``, with company or name."""
    contacts = (("e", present(F.col("email_normalized"))), ("p", phone))
    blocks = (("c", present(F.col("company_normalized"))), ("n", present(F.col("name_normalized"))))
    keys = [F.concat_ws("|", F.lit(a + b), v, w) for a, v in contacts for b, w in blocks]
    have = [v.isNotNull() & w.isNotNull() for _, v in contacts for _, w in blocks]
    return F.array_compact(F.array(*[F.when(both, key) for both, key in zip(have, keys)]))


def _tail_keys() -> Column:
    """Hashes of such values: those that share one by chance are told apart by their score."""
    return F.transform(_near_keys(phone_tail(present(F.col("phone_normalized")))), lambda key: F.xxhash64(key))


def _first_guess(kinds: DataFrame, best: DataFrame) -> DataFrame:
    """``(a_kind, target)`` to start from: rows that surely match each other go where the first of them goes.

    ``best (a_kind, id)`` is the best stored lead of a row as the table is. A kind
    has the number of its first row. Kinds that share nothing are not there.
    """
    keys = kinds.select("a_kind", F.explode(_near_keys(present(F.col("phone_normalized")))).alias("key"))
    low = keys.groupBy("key").agg(F.min("a_kind").alias("low"))
    parents = written(keys.join(shuffled(low), "key").groupBy("a_kind").agg(F.min("low").alias("parent")), "parents")
    above = parents.select(F.col("a_kind").alias("parent"), F.col("parent").alias("root"))
    roots = parents.join(shuffled(above), "parent").select("a_kind", "root")
    first = best.select(F.col("a_kind").alias("root"), "id")
    return roots.join(first, "root", "left").select("a_kind", F.coalesce("id", -F.col("root")).alias("target"))


def _with_words(rows: DataFrame) -> DataFrame:
    """``rows`` with their words, which are dear and so found once and not in every round."""
    return rows.withColumns({w: token_string(F.col(c)) for w, c in _WORDS.items()})


def _events(placed: DataFrame, exact: DataFrame, stored: DataFrame) -> DataFrame:
    """``(target, at, created, fields)``: what leads start from (``at`` 0 for stored ones), and what rows bring them."""
    created = F.col("target") == -F.col("seq")
    fields = [F.col(c) for c in (*_STATE, *_WORDS)]
    brought = placed.select("target", F.col("seq").alias("at"), created.alias("created"), *fields)
    fixed = exact.select(F.col("id").alias("target"), F.col("seq").alias("at"), F.lit(False).alias("created"), *fields)
    base = stored.select(F.col("id").alias("target"), F.lit(0).cast("bigint").alias("at"), F.lit(True).alias("created"), *fields)
    return base.unionByName(brought).unionByName(fixed)


def _versions(events: DataFrame) -> DataFrame:
    """``(target, at, until, marks, keys, fields)``: every state that a lead goes through, and from which row to which it has it.

    The state holds for rows after ``at`` up to ``until``. Each field has the last
    value that was not empty; name and company in matching form stay those of the
    beginning. The marks stand for the fields, and ``keys`` are those it is found by.
    Where a lead has very many rows, those that bring what the row before brought
    are left out first, within stretches, so many copies for one lead meet in no task.
    """
    slim = events
    if not events.groupBy("target").agg(F.count("*").alias("n")).where(F.col("n") > _STRETCH).isEmpty():
        values = F.struct(*[present(F.col(c)).alias(c) for c in _CHANGED])
        slim = events.withColumn("values", values)
        stretch = Window.partitionBy("target", F.floor(F.col("at") / _STRETCH)).orderBy("at")
        before = F.lag("values").over(stretch)
        slim = slim.withColumn("repeats", before.isNotNull() & (before == F.col("values")) & ~F.col("created"))
        slim = slim.where(~F.coalesce("repeats", F.lit(False))).drop("repeats", "values")
    order = Window.partitionBy("target").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    kept = {c: F.last(present(F.col(c)), ignorenulls=True).over(so_far) for c in _CHANGED}
    kept |= {c: F.first(c).over(so_far) for c in ("name_normalized", "company_normalized", *_WORDS)}
    # rows whose target was not created before them belong to no lead yet
    begun = F.first("created").over(so_far)
    states = slim.select("target", "at", begun.alias("begun"), *[v.alias(c) for c, v in kept.items()]).where("begun")
    # missing and empty are the same in a match
    fields = [F.coalesce(c, F.lit("")) for c in _STATE]
    states = states.withColumns({"mark": F.xxhash64(*fields), "mark2": F.xxhash64(F.lit(1), *fields)})
    mark = F.struct(*_MARK)
    changed = ~F.lag(mark).over(order).eqNullSafe(mark)
    states = states.withColumn("new", changed).where("new")
    until = F.coalesce(F.lead("at").over(order), F.lit((1 << 62)))
    states = states.select("target", "at", until.alias("until"), *_MARK, *_STATE, *_WORDS)
    return states.withColumn("keys", _tail_keys())


def _alike(rows: DataFrame, row: str, columns: list[str], kind: str, *more: Column) -> tuple[DataFrame, DataFrame]:
    """``(row, kind)`` and ``(kind, columns)``: rows alike in the columns are one kind, named by its smallest ``row``.

    Missing text becomes empty, which no match tells from it.
    """
    filled = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    rows = rows.withColumns(filled)
    first = written(rows.groupBy(*columns).agg(F.min(row).alias(kind), *more), "kinds")
    return rows.join(shuffled(first.select(kind, *columns)), columns), first


def _kind_fields(kinds: DataFrame, side: str, names: list[str]) -> DataFrame:
    """``(names, side_ scoring fields)`` of kinds, which go by the columns ``names``."""
    fields = scoring_fields(kinds.withColumn("id", F.lit(None)), *[F.col(c) for c in names], words=[F.col(c) for c in _WORDS])
    # no text holds a NUL, so it can stand for a missing country in comparisons
    fields = fields.withColumn("country_key", F.coalesce("country_key", F.lit("\0")))
    return fields.select(*names, *[F.col(c).alias(f"{side}_{c}") for c in _ALIKE])


def _row_kinds(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(seq, a_kind)``, the kinds of submissions with ``n``, and the kinds' scoring fields."""
    named, kinds = _alike(rows.select("seq", *_PROBE), "seq", _PROBE, "a_kind", F.count("*").alias("n"))
    nothing = F.lit(None).cast("string")
    fields = _kind_fields(_with_words(kinds.withColumns({"first_name": nothing, "last_name": nothing})), "a", ["a_kind"])
    return written(named.select("seq", "a_kind"), "named"), kinds, written(fields, "fields")


def _static(rows: DataFrame, scores: DataFrame, members: DataFrame, versions: DataFrame) -> DataFrame:
    """``(seq, target, score)``: for each row and group of leads that were alike, the first lead still unchanged.

    ``members (first, b_id)`` are the groups, ``scores (a_kind, id, score)`` those of
    kinds of rows and groups, ``rows (seq, a_kind)`` the rows asked for.
    """
    touched = versions.where("target > 0 AND at = 0 AND until < (1L << 62)").select(F.col("target").alias("b_id"), "until")
    marked = members.join(touched, "b_id", "left")
    # per group its first lead that nothing changes, and the changed ones before it
    quiet = F.min(F.when(F.col("until").isNull(), F.col("b_id")))
    groups = marked.groupBy("first").agg(quiet.alias("quiet"), F.count("until").alias("n"))
    some = rows.join(scores.withColumnRenamed("id", "first").join(groups, "first"), "a_kind")
    still = some.where("n > 0").select("seq", "first").join(marked.where("until IS NOT NULL"), "first").where("seq <= until")
    still = still.groupBy("seq", "first").agg(F.min("b_id").alias("busy"))
    found = some.join(still, ["seq", "first"], "left").withColumn("target", F.least("quiet", "busy"))
    return found.where("target IS NOT NULL").select("seq", "target", "score")


def _dynamic(rows: DataFrame, keys: DataFrame, fields: DataFrame, versions: DataFrame) -> DataFrame:
    """``(seq, target, score)``: rows and the leads that the batch changed or added, as they are at that row.

    ``rows (seq, a_kind)`` are the rows asked for, ``keys (a_kind, key)`` and ``fields``
    those of the kinds. A kind meets a lead that shares a key with it in any state;
    the state as of a row is then the last one before it in the lead's order of
    events, so that rows and states of a lead are sorted and not paired. Rows that
    are alike are scored once with states that are.
    """
    ours = versions.where("NOT (target > 0 AND at = 0)")
    met = ours.select("target", F.explode("keys").alias("key"))
    if rows.count() <= FEW:
        # late rounds have few rows, which meet few versions
        some_keys = keys.join(F.broadcast(rows.select("a_kind").distinct()), "a_kind", "left_semi")
        met = met.join(F.broadcast(some_keys), "key")
    else:
        met = met.distinct().join(keys.join(rows.select("a_kind").distinct(), "a_kind", "left_semi"), "key")
    met = written(met.select("a_kind", "target").distinct(), "met")
    states = ours.join(sized(met.select("target")).distinct(), "target", "left_semi")
    nothing = F.lit(None).cast("bigint")
    asked = rows.join(met, "a_kind").select("target", F.col("seq").alias("time"), F.lit(0).alias("state"), "a_kind", *[nothing.alias(c) for c in _MARK])
    given = states.select("target", F.col("at").alias("time"), F.lit(1).alias("state"), nothing.alias("a_kind"), *_MARK)
    # a row comes before the state that it brings itself
    order = Window.partitionBy("target").orderBy("time", "state").rowsBetween(Window.unboundedPreceding, 0)
    near = asked.unionByName(given).withColumns({c: F.last(c, ignorenulls=True).over(order) for c in _MARK})
    near = near.where("state = 0 AND mark IS NOT NULL").select(F.col("time").alias("seq"), "target", "a_kind", *_MARK)
    near = written(near, "near")
    # the marks stand for the rest, and by them the pairs are joined
    kinds = states.select(*_MARK, *[F.coalesce(c, F.lit("")).alias(c) for c in (*_STATE, *_WORDS)]).repartition(*_MARK).distinct()
    kinds = kinds.join(near.select(*_MARK).distinct(), _MARK, "left_semi")
    pairs = near.select("a_kind", *_MARK).distinct().join(fields, "a_kind").join(_kind_fields(kinds, "b", _MARK), _MARK)
    absent = {c: F.nullif(F.col(c), F.lit("\0")) for c in ("a_country_key", "b_country_key")}
    scored = score_pairs(pairs.withColumns(absent), MERGE_CONFIDENCE, ["a_kind", *_MARK]).select("a_kind", *_MARK, "score")
    return near.join(scored, ["a_kind", *_MARK]).select("seq", "target", "score")


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(target, at, until, keys)``: the rows after ``at`` up to ``until`` meet a lead, found by ``keys``, in other states than before."""
    same = before.unionByName(after).groupBy("target", "at", *_MARK, "keys")
    states = same.agg(F.count("*").alias("n"), F.min("until").alias("low"), F.max("until").alias("high"))
    states = states.where("n = 1 OR low < high")
    # a state that begins alike and ends elsewhere differs from the earlier end on
    return states.select("target", F.when(F.col("n") == 1, F.col("at")).otherwise(F.col("low")).alias("at"), F.col("high").alias("until"), "keys")


def _affected(changed: DataFrame, before: DataFrame, after: DataFrame, named: DataFrame, keys: DataFrame, scores: DataFrame, members: DataFrame) -> DataFrame:
    """``(seq, a_kind)`` of the rows whose candidates differ since leads are reached otherwise.

    ``changed (target, since)`` are the leads that gained or lost a row, and the first
    such row. ``before`` and ``after`` are the versions of these leads then and now,
    ``named (seq, a_kind)`` all rows. Rows that come while a lead is as it was meet it
    as they did, and so do those that share no key with it while it differs.
    """
    differing = written(_differing(before, after), "differing")
    span = [F.min("at").alias("at"), F.max("until").alias("until")]
    shared = differing.select(F.explode("keys").alias("key"), "at", "until").groupBy("key").agg(*span)
    groups = members.join(differing.select(F.col("target").alias("b_id"), "at", "until"), "b_id").groupBy(F.col("first").alias("id")).agg(*span)
    kinds = keys.join(shared, "key").select("a_kind", "at", "until")
    kinds = kinds.unionByName(scores.join(groups, "id").select("a_kind", "at", "until"))
    return named.join(kinds.groupBy("a_kind").agg(*span), "a_kind").where("seq > at AND seq <= until").select("seq", "a_kind")


def _resolve_open(rows: DataFrame, exact: DataFrame, leads: DataFrame) -> DataFrame:
    """``(seq, target)`` of the rows without exact match that have contact data.

    What a row matches depends on what earlier rows did to the leads. All rows are
    settled at once, from a guess: the guess gives every lead its states over time,
    and against the states as of its turn each row is matched anew. This is
    repeated, for rows that share a key with a lead and come while its state is
    another than before, until nothing changes. A round gives new states to leads
    alone that gained or lost a row, and moves only what rows of its own size it
    takes to look these up. A row whose predecessors are right is right after the next round, so
    the result is that of going row by row, and there are as many rounds as the
    longest chain of corrections, not as there are rows.
    """
    slim = written(_with_words(rows.select("seq", *_STATE)), "open")
    hit = exact.select("id").distinct()
    # rows that are alike are looked up once; what they come to is a matter of their turn
    named, kinds, fields = _row_kinds(slim)
    candidates = written(_candidates(kinds, leads, hit), "candidates")
    scores = written(fuzzy_scores(fields, kinds, candidates), "scores")
    groups = scores.select(F.col("id").alias("first")).distinct()
    members = written(candidates.select("first", "b_id").distinct().join(groups, "first", "left_semi"), "alike")
    best = scores.groupBy("a_kind").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("id"))
    keys = written(kinds.select("a_kind", F.explode(_tail_keys()).alias("key")), "keys")
    # leads that a row can come to are few; their beginnings are looked up in every round
    reached = members.select(F.col("b_id").alias("id")).unionByName(hit).distinct()
    stored = written(_with_words(leads.join(shuffled(reached), "id", "left_semi").select("id", *_STATE)), "reached")
    fixed = written(_with_words(exact.select("seq", "id", *_STATE)), "fixed")

    guess = named.join(shuffled(_first_guess(kinds, best)), "a_kind", "left").select("seq", F.coalesce("target", -F.col("seq")).alias("target"))
    # rows stay with what they bring, so that the states of a lead need no join
    placed = _Patched("seq", "targets", guess.join(shuffled(slim), "seq"))
    versions = _Patched("target", "versions", _versions(_events(placed.rows(), fixed, stored)))
    active = named
    while True:
        found = _static(active, scores, members, versions.rows()).unionByName(_dynamic(active, keys, fields, versions.rows()))
        order = F.struct("score", F.col("target") > 0, -F.abs("target"))
        best = found.groupBy("seq").agg(F.max_by("target", order).alias("better"))
        again = active.select("seq").join(best, "seq", "left").select("seq", F.coalesce("better", -F.col("seq")).alias("now"))
        was = placed.rows().withColumnRenamed("target", "was").join(sized(active).select("seq"), "seq")
        moved = written(was.join(again, "seq").where("now <> was").withColumnRenamed("now", "target"), "moved")
        if moved.isEmpty():
            return placed.rows().select("seq", "target")
        both = moved.select("target", "seq").unionByName(moved.select(F.col("was").alias("target"), "seq"))
        changed = written(both.groupBy("target").agg(F.min("seq").alias("since")), "changed")
        placed.replace(moved.select("seq"), moved.drop("was"))
        # only leads that gained or lost a row have other states than before
        leads_now = sized(changed.select("target"))
        ours = [leads_now.withColumnRenamed("target", "id"), "id", "left_semi"]
        events = _events(placed.rows().join(leads_now, "target", "left_semi"), fixed.join(*ours), stored.join(*ours))
        newer = written(_versions(events), "newer")
        older = versions.rows().join(leads_now, "target", "left_semi")
        active = written(_affected(changed, older, newer, named, keys, scores, members), "active")
        if active.isEmpty():
            return placed.rows().select("seq", "target")
        versions.replace(changed.select("target"), newer)


def merge_decisions(leads: DataFrame, rows: DataFrame) -> DataFrame:
    """``(seq, action, target)`` for every normalised submission.

    ``action`` is inserted, updated or skipped. The target is the id of a stored
    lead, or the negative ``seq`` of the submission that brought a new lead.
    """
    rows = rows.where("identified")
    exact = written(match_exact(rows, leads).select("seq", "id"), "exact")
    open_rows = rows.join(shuffled(exact.select("seq")), "seq", "left_anti")
    contact = present(F.col("email_normalized")).isNotNull() | present(F.col("phone_normalized")).isNotNull()
    # without e-mail and phone no score gets past 0.60
    unknown = open_rows.where(~contact).select("seq", (-F.col("seq")).alias("target"))
    found = _resolve_open(open_rows.where(contact), rows.join(shuffled(exact), "seq"), leads)
    targets = (
        exact.select("seq", F.col("id").alias("target")).unionByName(unknown).unionByName(found)
    )
    action = F.when(F.col("target") == -F.col("seq"), "inserted").otherwise("updated")
    return targets.select("seq", action.alias("action"), "target")


# fields that take the last non-empty value submitted
_LATEST = [
    "first_name",
    "last_name",
    "full_name",
    "company_name",
    "email",
    "email_normalized",
    "phone_number",
    "phone_normalized",
    "country",
    "notes",
]


def _folded(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per target the last non-empty value of every field, and the last source."""
    hits = decisions.select("seq", "target").join(shuffled(rows), "seq")
    latest = [F.max_by(c, F.when(present(F.col(c)).isNotNull(), F.col("seq"))).alias(c) for c in _LATEST]
    source = [F.max_by(c, "seq").alias(c) for c in ("source_channel", "source_detail")]
    folded = hits.groupBy("target").agg(*latest, *source)
    return folded.select("target", F.struct(*_LATEST, "source_channel", "source_detail").alias("_new"))


@dataclass
class Merge:
    """Outcome of a merge: the next lead table, what was done with each row, and the leads that are new or differ."""

    leads: DataFrame
    decisions: DataFrame
    rows: DataFrame
    changed: DataFrame

    def report(self) -> DataFrame:
        """One row of counts; errors are the items that could not be read, see ``sources.files``."""
        counts = self.decisions.agg(
            F.count_if(F.col("action") == "inserted").alias("inserted"),
            F.count_if(F.col("action") == "updated").alias("updated"),
        )
        broken = _error(self.rows).isNotNull()
        total = self.rows.agg(
            F.count("*").alias("total_rows"),
            F.count_if(~F.col("identified") & ~broken).alias("skipped"),
            F.count_if(broken).alias("errors"),
        )
        both = total.withColumn("_one", F.lit(1)).join(counts.withColumn("_one", F.lit(1)), "_one")
        return both.select("total_rows", "inserted", "updated", "skipped", "errors")

    def messages(self) -> DataFrame:
        """``(seq, message)`` for every skipped row and every item that could not be read."""
        return item_messages(self.rows)


def _error(rows: DataFrame) -> Column:
    """What is wrong with a row, null if nothing is; feeds without the column have no such rows."""
    return F.col("error") if "error" in rows.columns else F.lit(None).cast("string")


def item_messages(rows: DataFrame) -> DataFrame:
    """``(seq, message)`` for every row without identifying fields, and every one with an error."""
    reason = F.coalesce(_error(rows), F.lit("no identifying fields"))
    text = F.format_string("Item %d: %s", "seq", reason)
    return rows.where("NOT identified").select("seq", text.alias("message"))


def merge_submissions(leads: DataFrame, submissions: DataFrame, largest: tuple[int, int] | None = None) -> Merge:
    """Merge normalised submissions, in the order of ``seq`` from 1, into the leads.

    ``leads`` may be just those that share a key with the submissions (see
    ``lookup_keys``); then ``largest`` gives the largest id and record id of the
    whole table, and only ``changed`` and ``decisions`` of the outcome are of use.

    Rows without name, e-mail, phone and company are skipped, and so are items that
    could not be read (``error`` not null); all others merge as if these were not
    there, and keep their numbers. An update takes
    over non-empty values and always the source; it leaves the normalised name
    and company, the status and the dates alone. New leads get consecutive ids
    and record ids in the order of arrival.
    """
    rows = written(submissions, "submissions")
    decisions = written(merge_decisions(leads, rows), "decisions")
    folded = _folded(rows, decisions)

    updates = shuffled(folded.where("target > 0").withColumnRenamed("target", "id"))
    hit = F.col("_new").isNotNull()
    columns = {c: F.coalesce(F.col(f"_new.{c}"), F.col(c)) for c in _LATEST}
    columns |= {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in ("source_channel", "source_detail")}
    columns["original_source"] = F.when(hit, "Website Form").otherwise(F.col("original_source"))
    values = [columns.get(c, F.col(c)).alias(c) for c in LEAD_COLUMNS]
    whole = leads.join(updates, "id", "left").select(*values)
    changed = leads.join(updates, "id").select(*values)

    new = decisions.where("action = 'inserted'").select("seq").join(
        shuffled(folded.where("target < 0").select((-F.col("target")).alias("seq"), "_new")), "seq"
    )
    fixed = rows.select("seq", "page_url", "submitted_at", "name_normalized", "company_normalized")
    new = number_rows(new.join(shuffled(fixed), "seq"), "seq", "_n")
    if largest is None:
        top = [max_value(leads, c).scalar() for c in ("id", "record_id")]
    else:
        top = [F.lit(n).cast("bigint") for n in largest]
    next_id, next_record = top[0] + 1, top[1] + 1
    values = {c: F.col(f"_new.{c}") for c in [*_LATEST, "source_channel", "source_detail"]}
    values |= {
        "id": F.col("_n") + next_id,
        "record_id": F.col("_n") + next_record,
        "lead_status": F.lit("New"),
        "original_source": F.lit("Website Form"),
        "original_source_drill_down_1": F.col("page_url"),
        "create_date": F.col("submitted_at"),
        "last_modified_date": F.col("submitted_at"),
        "name_normalized": F.col("name_normalized"),
        "company_normalized": F.col("company_normalized"),
    }
    types = {f.name: f.dataType for f in leads.schema}
    inserted = new.select(*[values.get(c, F.lit(None)).cast(types[c]).alias(c) for c in LEAD_COLUMNS])
    return Merge(whole.unionByName(inserted), decisions, rows, changed.unionByName(inserted))
