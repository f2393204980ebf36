"""Personal data by weak supervision. DataFrame functions only.

Strict patterns give the base spans. Looser patterns propose more; a regex, a gazetteer, a
context and a boundary labeler vote (-1, 0, 1) on every proposal and every base span. Per kind,
expectation maximisation over the counts of vote patterns estimates how reliable each labeler is,
with base spans known to be true; the soft labels it gives train a naive Bayes classifier over
span features, which decides about the proposals. All smoothing is a share of the counts, so a
text's spans are the same however often the table's rows are repeated. Only tables of fixed size
(vote patterns, feature values) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize

# The base kinds in order with their patterns. The look-behinds and possessive
# parts change no match; they keep the search linear on long runs of one character class.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposals beyond the base patterns.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63}+)++",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Don|Doña|Señor|Señora)\.? \p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30})?",
    "secret": r"(?<![\p{L}\p{N}])(?i:token|secret|password|passwd|api[_-]?key)(?-i)[\"']? ?[:=] ?[\"']?[A-Za-z0-9_-]{4,256}+[\"']?",
    "card": r"(?<![0-9.+-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![0-9])",
}
KINDS = ["email", "ip", "card", "phone", "name", "secret"]
LABELERS = ["regex", "gazetteer", "context", "boundary"]
# Words before a span that speak for its kind, and against any.
CUES = {
    "email": "mail|kontakt|contact|write|correo|courriel", "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta", "phone": "phone|tel|call|mobile|anruf|appel|llama",
    "name": "name|by|from|von|signed|dear|sehr|cher|estimad", "secret": "auth|login|api|key|bearer|config",
}
AGAINST = r"(?i)(version|license|licence|isbn|issn|doi|page|chapter|seite|section|copyright|figure|table|example|sample)\W{0,3}$"
# Fixed values, the gazetteers: top domains, card issuers' first digits, given names and surnames
# common in the four languages, and values that only stand for a secret.
TOP_DOMAINS = "com|org|net|edu|gov|mil|int|io|info|biz|de|fr|es|uk|eu|ch|at|it|nl|be|us|ca|mx|ar|pt|br|pl|se|no|dk|fi|jp|cn|in|au"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|62)"
GIVEN = ("Anna|Maria|Peter|Paul|John|James|Mary|Robert|Michael|David|Thomas|Hans|Karl|Klaus|Stefan|Julia|Laura|Sofia|Lucia|Carlos|Juan|"
         "José|Luis|Miguel|Carmen|Pierre|Jean|Jacques|Marie|Claire|Louis|Sophie|Emma|Lukas|Martin|Elena|Pablo|Antonio|Sarah|Linda")
SURNAMES = ("Smith|Jones|Brown|Taylor|Miller|Wilson|Davis|Müller|Schmidt|Schneider|Fischer|Weber|Meyer|Wagner|Becker|Martin|Bernard|Dubois|"
            "Durand|Moreau|Laurent|García|Fernández|González|Rodríguez|López|Martínez|Sánchez|Pérez|Gómez|Hoffmann|Johnson|Williams|Clark")
PLACEHOLDER = "(?i)(?:example|changeme|your|xxxx|test|none|null|dummy|placeholder|sample|1234|abcd|password|secret)"
ROUNDS, BLOCK = 50, 256
# What is believed of the labelers before any count, as P(vote | truth) for (-1, 0, 1); it weighs as
# much as the share WEIGHT of a kind's spans. A feature value is taken to be one of VALUES.
WEIGHT = 0.5
TRUE = [(0.10, 0.30, 0.60), (0.15, 0.45, 0.40), (0.05, 0.65, 0.30), (0.10, 0.05, 0.85)]
FALSE = [(0.60, 0.30, 0.10), (0.40, 0.45, 0.15), (0.15, 0.75, 0.10), (0.25, 0.05, 0.70)]
VALUES = 20


def _prefix(lengths: Column) -> Column:
    """Exclusive running sums of a short array."""
    return F.aggregate(lengths, F.struct(F.lit(0).cast("long").alias("t"), F.expr("CAST(array() AS array<bigint>)").alias("out")),
                       lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["out"], F.array(s["t"])).alias("out")))["out"]


def _with(x: Column, **more: Column) -> Column:
    for name, value in more.items():
        x = x.withField(name, value)
    return x


def _placed(sets: DataFrame) -> DataFrame:
    """Give every match its place: one array column ``spans`` from the matches of each pattern.

    ``sets`` is an array of (kind, base, m, p): matches and the pieces of text around them. Places
    are running sums of lengths, taken in blocks of 256 so that work stays near linear in the
    number of matches.
    """
    each = lambda f: F.transform("sets", f)
    df = sets.withColumn("sets", each(lambda x: _with(x, l=F.zip_with(
        F.slice(x["p"], F.lit(1), F.size(x["m"])), x["m"], lambda p, m: (F.length(p) + F.length(m)).cast("long")))))
    df = df.withColumn("sets", each(lambda x: _with(x, b=F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x["l"]) - 1) / BLOCK).cast("int")),
        lambda i: F.slice(x["l"], i * BLOCK + 1, F.lit(BLOCK))))))
    df = df.withColumn("sets", each(lambda x: _with(x, o=_prefix(F.transform(
        x["b"], lambda y: F.aggregate(y, F.lit(0).cast("long"), lambda a, v: a + v))))))
    df = df.withColumn("sets", each(lambda x: _with(x, s=F.flatten(F.zip_with(
        x["b"], x["o"], lambda y, off: F.transform(_prefix(y), lambda v: v + off))))))
    spans = F.flatten(each(lambda x: F.transform(x["m"], lambda m, i: F.struct(
        x["kind"].alias("kind"), x["base"].alias("base"),
        (F.get(x["s"], i) + F.length(F.get(x["p"], i))).alias("start"),
        (F.get(x["s"], i) + F.get(x["l"], i)).alias("end"), m.alias("text"),
        F.right(F.get(x["p"], i), F.lit(40)).alias("before"), F.left(F.get(x["p"], i + 1), F.lit(10)).alias("after")))))
    return df.withColumn("spans", spans).drop("sets")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(d * 2 - 9 * (d > 4)) for d in range(10)]),
                     F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return (total % 10) == 0


def _valid(x: Column) -> Column:
    """Whether a match of a base pattern meets its kind's rule."""
    kind, digits = x["kind"], _digits(x["text"])
    parts = F.forall(F.split(x["text"], r"\."), lambda p: (
        (F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)))
    return (F.when(kind == "ip", parts)
            .when(kind == "card", F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(10, 15)).otherwise(True))


def _value(text: Column) -> Column:
    """What a secret is set to."""
    return F.regexp_extract(text, r"[:=] ?[\"']?([A-Za-z0-9_-]+)", 1)


def _votes(x: Column) -> Column:
    """Votes of the four labelers (-1, 0, 1) on one span."""
    kind, text = x["kind"], x["text"]
    digits, value = _digits(text), _value(text)
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    strict = (F.when(x["base"], 1)
              .when(kind == "email", vote(F.lower(text).rlike(r"(?:\.|dot[\])] ?)[a-z]{2,6}$"), text.rlike("[0-9]$")))
              .when(kind == "card", vote(F.length(digits).between(14, 19) & luhn(digits), ~luhn(digits)))
              .when(kind == "phone", vote(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[01]|^[0-9]{3}[01]")))
              .when(kind == "name", vote(text.rlike(r" \p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$"), F.lit(False)))
              .when(kind == "secret", vote((F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]"),
                                           (F.length(value) < 8) | ~value.rlike("[0-9]")))
              .otherwise(0))
    gazetteer = (F.when(kind == "email", vote(F.lower(text).rlike(rf"(?:\.|dot[\])] ?)(?:{TOP_DOMAINS})$"), F.lit(True)))
                 .when(kind == "card", vote(digits.rlike(ISSUERS), F.lit(True)))
                 .when(kind == "ip", vote(F.lit(False), text.rlike(r"^(?:0|127|255)\.")))
                 .when(kind == "phone", vote(digits.rlike(r"555[0-9]{4}$|^(?:1|33|34|44|49)"), F.lit(False)))
                 .when(kind == "name", vote(text.rlike(rf" (?:{GIVEN}|{SURNAMES})(?: |$)"), F.lit(False)))
                 .when(kind == "secret", vote(F.lit(False), value.rlike(PLACEHOLDER)))
                 .otherwise(0))
    cues = F.lit(None)
    for name, words in CUES.items():
        cues = F.when(kind == name, F.lower(x["before"]).rlike(words)).otherwise(cues)
    context = F.when(x["before"].rlike(AGAINST), -1).when(cues, 1).otherwise(0)
    boundary = F.when(x["before"].rlike(r"[\p{L}\p{N}]$") | x["after"].rlike(r"^[\p{L}\p{N}]"), -1).otherwise(1)
    return F.array(strict, gazetteer, context, boundary)


def _side(text: Column) -> Column:
    return (F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "edge").when(text.rlike(r"^\s$"), "blank")
            .when(text.rlike(r"^\p{L}$"), "letter").when(text.rlike(r"^\p{N}$"), "digit").otherwise("mark"))


def _features(x: Column) -> Column:
    kind = x["kind"]
    digits = F.length(_digits(x["text"]))
    named = lambda name, value: F.concat(kind, F.lit(f"|{name}|"), value.cast("string"))
    return F.array(named("length", F.least(F.floor(F.length(x["text"]) / 4), F.lit(15))),
                   named("digits", F.least(digits, F.lit(20))), named("left", _side(F.right(x["before"], F.lit(1)))),
                   named("right", _side(F.left(x["after"], F.lit(1)))),
                   *[named(labeler, F.element_at(x["votes"], i + 1)) for i, labeler in enumerate(LABELERS)])


@dataclass(frozen=True)
class Reliability:
    """Estimates by kind: prior, P(vote | truth) by labeler, and the posterior by (kind, votes)."""
    prior: dict[str, float]
    vote: dict[str, list[dict[tuple[int, bool], float]]]
    posterior: dict[tuple[str, tuple[int, ...]], float]


def believed(votes: tuple[int, ...]) -> float:
    """Probability that a span is true by the beliefs alone, true and not true alike before the votes."""
    odds = math.prod(TRUE[i][s + 1] / FALSE[i][s + 1] for i, s in enumerate(votes))
    return odds / (1 + odds)


def estimate(patterns: list[tuple[str, bool, tuple[int, ...], int]]) -> Reliability:
    """Expectation maximisation over (kind, base, votes, count), kind by kind; base spans are true.

    At most 2 * 6 * 3**4 patterns. Multiplying all counts by one number changes nothing.
    """
    prior: dict[str, float] = {}
    vote: dict[str, list[dict[tuple[int, bool], float]]] = {}
    posterior: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in sorted({k for k, *_ in patterns}):
        known = [(v, n) for k, base, v, n in patterns if k == kind and base]
        asked = [(v, n) for k, base, v, n in patterns if k == kind and not base]
        total = sum(n for _, n in known + asked)
        post = {v: believed(v) for v, _ in asked}
        for _ in range(ROUNDS):
            true = sum(n for _, n in known) + sum(n * post[v] for v, n in asked)
            # the prior is that of proposals: base spans say nothing about how many of those are true
            open_ = sum(n for _, n in asked)
            prior[kind] = (sum(n * post[v] for v, n in asked) + WEIGHT * total / 2) / (open_ + WEIGHT * total)
            vote[kind] = []
            for i in range(len(LABELERS)):
                table = {}
                for truth in (True, False):
                    mass = {s: WEIGHT * total * (TRUE if truth else FALSE)[i][s + 1] for s in (-1, 0, 1)}
                    for v, n in asked:
                        mass[v[i]] += n * (post[v] if truth else 1 - post[v])
                    for v, n in known if truth else []:
                        mass[v[i]] += n
                    size = WEIGHT * total + (true if truth else total - true)
                    table |= {(s, truth): m / size for s, m in mass.items()}
                vote[kind].append(table)
            for v, _ in asked:
                odds = math.log(prior[kind] / (1 - prior[kind])) + sum(
                    math.log(vote[kind][i][s, True] / vote[kind][i][s, False]) for i, s in enumerate(v))
                post[v] = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
        posterior |= {(kind, v): p for v, p in post.items()}
    return Reliability(prior, vote, posterior)


def feature_weights(mass: dict[str, tuple[float, float]], spans: dict[str, float]) -> dict[str, float]:
    """Log ratio of each feature value (``kind|feature|value``) from its soft counts (true, not true);
    ``spans`` has the spans of each kind."""
    totals: dict[str, list[float]] = {}
    for f, (yes, no) in mass.items():
        sums = totals.setdefault(f.rsplit("|", 1)[0], [0.0, 0.0])
        sums[0] += yes
        sums[1] += no
    out = {}
    for f, (yes, no) in mass.items():
        all_yes, all_no = totals[f.rsplit("|", 1)[0]]
        share = 0.1 * WEIGHT * spans[f.split("|", 1)[0]] / VALUES
        out[f] = math.log((yes + share) / (all_yes + VALUES * share)) - math.log((no + share) / (all_no + VALUES * share))
    return out


def _literal_map(values: dict[str, float]) -> Column:
    flat = [F.lit(x) for item in values.items() for x in item]
    return F.create_map(*flat) if flat else F.expr("CAST(map() AS map<string,double>)")


def find_spans(docs: DataFrame) -> DataFrame:
    """Candidate spans of each row: doc_id, ``base`` (valid strict matches) and ``loose``.

    Each span has kind, start and end (code points), votes and features; loose spans that touch
    a base span are left out. A null text is empty.
    """
    text = F.col("text")
    lower = F.lower(text)
    some = lambda column, *parts: F.greatest(*[F.contains(column, F.lit(x)) for x in parts])
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"_at": F.contains(text, F.lit("@")), "_digit": text.rlike("[0-9]")})
    # a pattern only runs over texts that hold what each of its matches must hold
    gates = [F.col("_at"), F.col("_digit"), F.col("_digit"), F.col("_digit") & F.contains(text, F.lit("+")),
             some(text, "(at)", "[at]", "(AT)", "[AT]"), F.col("_digit"),
             some(text, "Mr", "Ms", "Dr", "Prof", "Herr ", "Frau ", "Monsieur ", "Madame ", "Don ", "Doña ", "Señor"),
             some(lower, "token", "secret", "passw", "api"), F.col("_digit")]
    patterns = [(k, True, x) for k, x in BASE.items()] + [(k, False, x) for k, x in LOOSE.items()]
    df = df.withColumns({f"_m{i}": F.when(gate, F.regexp_extract_all("text", F.lit(x), F.lit(0)))
                         for i, (gate, (_, _, x)) in enumerate(zip(gates, patterns, strict=True))})
    sets = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(base).alias("base"), F.col(f"_m{i}").alias("m"),
                              F.when(F.size(f"_m{i}") > 0, F.split("text", x, -1)).alias("p"))
                     for i, (k, base, x) in enumerate(patterns)])
    df = df.select("doc_id", F.filter(sets, lambda x: F.size(x["m"]) > 0).alias("sets"))
    df = _placed(df).withColumn("spans", F.filter("spans", lambda x: ~x["base"] | _valid(x)))
    df = df.withColumn("spans", F.transform("spans", lambda x: x.withField("votes", _votes(x))))
    df = df.withColumn("spans", F.transform("spans", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"),
        x["votes"].alias("votes"), _features(x).alias("features"))))
    base, loose = F.filter("spans", lambda x: x["base"]), F.filter("spans", lambda x: ~x["base"])
    df = df.select("doc_id", base.alias("base"), loose.alias("loose"))
    clear = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return df.withColumn("loose", F.when(F.size("loose") > 0, clear).otherwise(F.col("loose")))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in listed order."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.array_position(rank, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Personal data of every row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans.

    ``docs`` has columns doc_id and text; others are not looked at. Null and empty texts have no
    spans; rows are judged one by one, repeated rows alike; an empty table gives no rows. The
    spans found are written to the shared folder once (no texts).
    """
    found, _ = materialize(find_spans(docs), "spans")
    every = found.select(F.explode(F.concat("base", "loose")).alias("x")).select("x.*")
    patterns = [(r.kind, r.base, tuple(r.votes), r.n) for r in
                every.groupBy("kind", "base", "votes").agg(F.count("*").alias("n")).collect()]
    told = estimate(patterns)
    key = F.concat_ws("|", "kind", F.array_join(F.transform("votes", lambda v: v.cast("string")), ","))
    posterior = _literal_map({f"{k}|{','.join(map(str, v))}": p for (k, v), p in told.posterior.items()})
    soft = every.withColumn("p", F.when(F.col("base"), 1.0).otherwise(F.element_at(posterior, key)))
    mass = {r.f: (r.yes, r.no) for r in soft.select(F.explode("features").alias("f"), "p").groupBy("f").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()}
    counts: dict[str, float] = {}
    for kind, _, _, n in patterns:
        counts[kind] = counts.get(kind, 0) + n
    weights = _literal_map(feature_weights(mass, counts))
    prior = _literal_map({k: math.log(p / (1 - p)) for k, p in told.prior.items()})
    score = lambda x: F.coalesce(F.element_at(prior, x["kind"]), F.lit(0.0)) + F.aggregate(
        x["features"], F.lit(0.0), lambda a, f: a + F.coalesce(F.element_at(weights, f), F.lit(0.0)))
    cut = math.log(threshold / (1 - threshold))
    added = F.when(F.size("loose") > 0, F.filter("loose", lambda x: score(x) >= cut)).otherwise(F.col("loose"))
    df = found.withColumn("added", added)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                     _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                     (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
