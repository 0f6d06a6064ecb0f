"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from patterns: the four base kinds (e-mail, IP address,
payment card, phone) and looser ones (national phone, social-security number,
access key, assigned secret, introduced name).  Labelers vote on each
candidate or abstain: a regex labeler judges its form, gazetteers judge known
pieces, a context labeler judges the words before it.  Expectation-
maximisation over the counts of vote patterns, a table of bounded size,
estimates each labeler's reliability per kind; its posteriors then train the
final span classifier, a naive Bayes model over span features (kind, length,
digits, cue, neighbour), again from counts.  Base spans always stay; a looser
span is added where the classifier gives it at least one half and no base span
overlaps it.

Edge cases: a null text counts as empty; offsets are in code points; repeated
rows each get their own result row; extra columns are ignored.  Patterns use
possessive runs and run starts only, so a text of any length takes time and
stack in proportion.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrlake.llm.common import id_and_text, stored

#: Base kinds in the order that breaks ties, then the looser ones.
BASE = ("email", "ip", "card", "phone")
LOOSE = ("local_phone", "ssn", "access_key", "secret", "name")
KINDS = BASE + LOOSE

# A run of the class is tried from its start, or from where a match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+|xox[abp]-[A-Za-z0-9-]{10,}+)",
    "secret": r"(?i)(?<![a-z0-9_])(?:api_?key|secret|password|passwd|token)\x20?[=:]\x20?[\"']?[a-z0-9+/_-]{12,}+(?:\.[a-z0-9+/_-]{12,}+)*+",
    "name": r"(?:[Mm]y name is|[Cc]ontact|[Ss]igned,?|Mr\.|Mrs\.|Ms\.|Dr\.)\x20\p{Lu}\p{Ll}++\x20\p{Lu}\p{Ll}++",
}

# What a text must hold for a pattern to be tried at all.
HINTS = {"email": "@", "phone": "+"}

# Fixed gazetteers of the labelers.
DOMAINS = "com org net edu gov io de fr es uk eu co info us ca".split()
CUES = "mail email contact call phone tel fax ssn card credit visa address ip server key token password secret name from to at".split()
DOUBTS = "version v release section chapter page item isbn issn figure table total sum id order rev build".split()
PLACEHOLDERS = "000-00-0000 123-45-6789 000.000.0000 555-55-5555".split()

VOTERS = ("form", "gazetteer", "context")
ROUNDS = 30
BEFORE = 24


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    digits = _digits(s)
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _keeps(kind: str):
    return lambda s: _valid(kind, s["span"])


def _of(kind: str):
    return lambda s: s["kind"] == kind


def _matches(kind: str, text: Column) -> Column:
    """The kind's leftmost matches that don't overlap."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    hint = HINTS.get(kind)
    some = text.contains(hint) if hint else text.rlike("[0-9]") if kind in ("ip", "card", "local_phone", "ssn") else F.lit(True)
    return F.when(some, found).otherwise(F.array().cast("array<string>"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): candidates of every kind, each with its start and
    end, text, the text before it and whether its form is valid."""
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    for kind in KINDS:
        rows = rows.withColumn(f"m_{kind}", _matches(kind, F.col("text")))
    placed = []
    for kind in KINDS:
        matches = F.col(f"m_{kind}")
        pieces = F.split("text", PATTERNS[kind], -1)
        # The texts between matches give the offsets: a match begins after all
        # earlier pieces and matches.  Cut only where there is a match.
        zipped = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
        empty = F.array().cast("array<struct<kind:string,start:int,end:int,span:string>>")
        fold = F.aggregate(
            zipped, F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    F.lit(kind).alias("kind"), (acc["at"] + x["gap"]).alias("start"),
                    (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"), x["m"].alias("span")))).alias("out")),
        )["out"]
        placed.append(F.when(F.size(matches) > 0, F.filter(fold, _keeps(kind))).otherwise(empty))
    rows = rows.select("doc_id", "text", F.concat(*placed).alias("spans"))
    around = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["span"].alias("span"),
        F.lower(F.substring(F.col("text"), F.greatest(s["start"] - BEFORE, F.lit(0)) + 1,
                            F.least(s["start"], F.lit(BEFORE)))).alias("before")))
    return rows.select("doc_id", F.when(F.size("spans") > 0, around).otherwise(F.array().cast(
        "array<struct<kind:string,start:int,end:int,span:string,before:string>>")).alias("spans"))


def _any(words: list[str]) -> str:
    return r"(?:^|[^a-z])(?:" + "|".join(words) + r")[^a-z]{0,4}(?:[a-z]{1,3}[^a-z]{1,3})?$"


def votes(s: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 personal, 0 not, -1 abstains."""
    span, kind = s["span"], s["kind"]
    digits = _digits(span)
    many = F.length(F.regexp_replace(digits, "(.)(?=.*\\1)", "")) >= 4  # at least four different digits
    form = (F.when(kind.isin("ip", "email"), F.lit(-1))
            .when(kind.isin("access_key", "secret"), F.when(span.rlike("[0-9]") & span.rlike("[A-Za-z]"), 1).otherwise(0))
            .when(kind == "name", F.lit(-1))
            .otherwise(F.when(many, 1).otherwise(0)))
    last = F.lower(F.regexp_extract(span, r"([A-Za-z]+)$", 1))
    known = (F.when(kind == "email", F.when(last.isin(*DOMAINS), 1).otherwise(-1))
             .when(kind == "ip", F.when(F.substring(span, 1, 3).isin("10.", "127") | span.startswith("192.168.") | span.startswith("0."), 0).otherwise(1))
             .when(kind == "card", F.when(F.substring(digits, 1, 1).isin("3", "4", "5", "6"), 1).otherwise(0))
             .when(kind == "access_key", F.lit(1))
             .when(span.isin(*PLACEHOLDERS), 0)
             .otherwise(F.lit(-1)))
    context = F.when(s["before"].rlike(_any(DOUBTS)), 0).when(s["before"].rlike(_any(CUES)), 1).otherwise(F.lit(-1))
    return {"form": form.cast("int"), "gazetteer": known.cast("int"), "context": context.cast("int")}


def features(s: Column) -> dict[str, Column]:
    """What the final classifier sees of a span, as small integers."""
    return {"length": F.least(F.floor(F.length(s["span"]) / 4), F.lit(12)).cast("int"),
            "digits": F.least(F.length(_digits(s["span"])), F.lit(20)).cast("int"),
            "cue": votes(s)["context"],
            "neighbour": F.when(s["before"].rlike(r"[a-z0-9]$"), 2).when(s["before"].rlike(r"\s$"), 1).otherwise(0).cast("int")}


@dataclass
class Model:
    """Log odds of each kind and of each (kind, feature, value)."""

    prior: dict[str, float]
    odds: dict[tuple[str, str, int], float]
    #: labeler's estimated accuracy where it votes, per kind.
    accuracy: dict[tuple[str, str], float]

    def log_odds(self, s: Column) -> Column:
        def lookup(table: dict[str, float], key: Column) -> Column:
            if not table:
                return F.lit(0.0)
            found = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
            return F.coalesce(F.element_at(found, key), F.lit(0.0))

        total = lookup(self.prior, s["kind"])
        for name, value in features(s).items():
            own = {f"{kind}:{v}": w for (kind, f, v), w in self.odds.items() if f == name}
            total = total + lookup(own, F.concat_ws(":", s["kind"], value.cast("string")))
        return total


def estimate(patterns: list[dict], rounds: int = ROUNDS) -> tuple[list[float], dict[tuple[str, str], float], dict[str, float]]:
    """EM over vote patterns ({kind, n, and each labeler's vote}).

    Returns the posterior of each pattern, each labeler's accuracy per kind
    and each kind's share of personal spans.
    """
    kinds = {p["kind"] for p in patterns}
    accuracy = {(k, v): 0.8 for k in kinds for v in VOTERS}
    share = {k: 0.7 for k in kinds}
    posterior = [0.5] * len(patterns)
    for _ in range(rounds):
        for i, p in enumerate(patterns):
            odds = math.log(share[p["kind"]] / (1 - share[p["kind"]]))
            for v in VOTERS:
                if p[v] >= 0:
                    a = accuracy[p["kind"], v]
                    odds += math.log(a / (1 - a)) * (1 if p[v] else -1)
            posterior[i] = 1 / (1 + math.exp(-odds))
        for k in kinds:
            own = [(p, q) for p, q in zip(patterns, posterior) if p["kind"] == k]
            total = sum(p["n"] for p, _ in own)
            share[k] = min(0.99, max(0.01, (sum(p["n"] * q for p, q in own) + 1.4) / (total + 2)))
            for v in VOTERS:
                voted = [(p["n"], q if p[v] else 1 - q) for p, q in own if p[v] >= 0]
                # Eight votes' worth of prior at 0.8 keep a labeler from flipping.
                accuracy[k, v] = min(0.99, max(0.51, (sum(n * r for n, r in voted) + 6.4) / (sum(n for n, _ in voted) + 8)))
    return posterior, accuracy, share


def fit(spans: DataFrame) -> Model:
    """Learn from all candidates (rows of one struct ``s``); only counts by
    vote pattern and by feature value, tables of bounded size, are collected."""
    s = F.col("s")
    named = spans.select(s["kind"].alias("kind"), *[v.alias(f"vote_{n}") for n, v in votes(s).items()],
                         *[f.alias(f"feature_{n}") for n, f in features(s).items()])
    names = list(features(s))
    counts = named.groupBy("kind", *[f"vote_{v}" for v in VOTERS], *[f"feature_{f}" for f in names]).count().collect()
    merged: dict[tuple, int] = {}
    for r in counts:
        key = (r["kind"], *[r[f"vote_{v}"] for v in VOTERS])
        merged[key] = merged.get(key, 0) + r["count"]
    keys = sorted(merged)
    posterior, accuracy, share = estimate([{"kind": k[0], "n": merged[k], **dict(zip(VOTERS, k[1:]))} for k in keys])
    belief = dict(zip(keys, posterior))
    yes: dict[tuple[str, str, int], list[float]] = {}
    sums: dict[str, list[float]] = {}
    for r in counts:
        q, n = belief[(r["kind"], *[r[f"vote_{v}"] for v in VOTERS])], r["count"]
        whole = sums.setdefault(r["kind"], [0.0, 0.0])
        whole[0] += n * q
        whole[1] += n * (1 - q)
        for f in names:
            part = yes.setdefault((r["kind"], f, r[f"feature_{f}"]), [0.0, 0.0])
            part[0] += n * q
            part[1] += n * (1 - q)
    odds = {key: math.log((a + 1) / (sums[key[0]][0] + 10)) - math.log((b + 1) / (sums[key[0]][1] + 10))
            for key, (a, b) in yes.items()}
    return Model({k: math.log(v / (1 - v)) for k, v in share.items()}, odds, accuracy)


def _listed(spans: Column, order: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    rank = F.array(*[F.lit(k) for k in order])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(rank, s["kind"]).alias("k"), s["end"], s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of span structs per document row."""
    rows = stored(candidates(docs), "pii-candidates")
    model = fit(rows.select(F.explode("spans").alias("s")))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    loose = F.filter("spans", lambda s: ~s["kind"].isin(*BASE) & (model.log_odds(s) >= 0))
    rows = rows.select("doc_id", base.alias("base"), loose.alias("loose"))
    free = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("doc_id", "base", free.alias("added"))


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans."""
    found = find(docs)
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base"), KINDS), 256).alias("base_sha256"),
                        _listed(F.concat("base", "added"), KINDS).alias("spans"))
