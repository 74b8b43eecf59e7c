"""Personal data by weak supervision, with DataFrame functions alone.

Base spans are the four patterns of the contract.  Beyond them, wider patterns propose candidates
(obfuscated addresses, phone numbers without a plus sign, grouped card numbers whose check digit fails, and, as the
kind ``secret``, a person's credentials: assigned passwords, tokens and keys, access key ids).
Labelers vote on every span, base or not, +1, -1 or 0:

 * format (regular expression): the strict pattern matches (a secret: 16 characters or more with a digit),
 * checksum or range: Luhn, parts up to 255, 9 to 15 digits, an alphabetic top-level domain, mixed letters and digits,
 * gazetteer: known top-level domains, issuer prefixes, country codes, public address ranges, forms of known keys,
 * context: cue words shortly before the span, for or against,
 * surroundings: the span stands free, or sticks to letters or digits.

Spans with the same votes and features are counted together (map-side), which leaves a table
bounded by the number of vote and feature combinations, not by the corpus.  Expectation-maximisation over that
table estimates how reliable each labeler is and how likely each vote pattern is personal data;
these soft labels train the final classifier, a naive Bayes model over features that no labeler sees.
Both read all spans of all documents; texts are read once, their judged spans are stored without them.  Spans beyond the base ones are accepted where votes and
classifier together give a probability of at least ``accept``, and only where they overlap no base span.

Offsets are code points, end exclusive.  A span's offset is the running length of the pieces
between matches, summed in blocks so that texts with very many matches stay near-linear.

Defined results: a null or empty text has no spans.  Without any spans in the corpus the model keeps its prior.  Each row gives a row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kestrel.llm.common import store, table

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")  # the last has no base spans

# Patterns of the base spans.  An anchored start with possessive repeats finds the same matches in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_VALID = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Wider candidate patterns.
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{2,64}+ ?(?:\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?[A-Za-z0-9-]{2,63}){1,4}",
    "phone": r"(?<![0-9+.-])(?<![0-9+] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])(?! [0-9])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![ -]?[0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:(?i:password|passwd|secret|token|api_?key)[\"']? {0,8}[:=] {0,8}[\"']?[A-Za-z0-9+/_.=-]{8,}+|AKIA[A-Z0-9]{16,}+)",
}
# Cheap conditions that a text with such a candidate meets.
NEEDS = {"email": r"(?i)[\[({]at[\])}]", "phone": r"[0-9]{3}[ .-][0-9]{4}", "card": r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}",
         "secret": r"[:=] {0,8}[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{16}"}

# Strict forms, whole spans.
STRICT = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$",
    "ip": r"^[0-9]+(\.[0-9]+){3}$",
    "card": r"^[0-9]([ -]?[0-9]){11,18}$",
    "phone": r"^\+[0-9][ ().0-9-]+[0-9]$",
    "secret": r"[0-9][A-Za-z0-9+/_.=-]*$",
}
KNOWN_KEYS = r"^([0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64}|AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk[-_][A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]+\..+)$"

# Gazetteers and cue words.
DOMAINS = "com|org|net|edu|gov|info|io|dev|co|biz|uk|de|fr|es|it|nl|eu|us|ca|au|ch|at|be|pl|jp|br|in|mx"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
COUNTRY = r"^\+(1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": ("mail|contact|write|reach|address|inbox|correo|adresse|courriel", "example of|syntax|pattern"),
    "ip": ("ip|address|host|server|client|login|from|adresse|direcci", "version|release|section|chapter|v\\."),
    "card": ("card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta", "isbn|order|invoice|tracking|serial|part no"),
    "phone": ("phone|tel|call|mobile|cell|fax|contact|whatsapp|anruf|appel|llam", "isbn|order|invoice|tracking|serial|part no"),
    "secret": ("login|auth|credential|account|config|export|header|user", "example of|dummy|placeholder|sample|syntax|pattern"),
}

BLOCK = 64
CONTEXT = 32
SPAN = "array<struct<start:bigint,rank:int,kind:string,stop:bigint,value:string,base:boolean>>"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _found(text: Column, pattern: str, kind: str, valid, base: bool) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` that pass ``valid``, as SPAN structs."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    # code points from the start of the text to the end of each match
    steps = F.zip_with(hits, F.slice(pieces, 1, F.size(hits)), lambda m, p: (F.char_length(p) + F.char_length(m)).cast("long"))
    rank = ALL_KINDS.index(kind)

    def spans(z):  # z: hits and steps, bound once
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(z["steps"]) - 1) / BLOCK).cast("int")),
                             lambda b: _sum(F.slice(z["steps"], b * BLOCK + 1, BLOCK)))
        return F.flatten(F.transform(F.array(F.struct(blocks.alias("blocks"))), lambda y: F.transform(
            z["hits"], lambda m, i: _span(m, _sum(F.slice(y["blocks"], 1, F.floor(i / BLOCK).cast("int")))
                                          + _sum(F.slice(z["steps"], (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), i % BLOCK + 1))))))

    def _span(m, stop):
        return F.struct((stop - F.char_length(m)).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                        stop.alias("stop"), m.alias("value"), F.lit(base).alias("base"))

    found = F.flatten(F.transform(F.array(F.struct(hits.alias("hits"), steps.alias("steps"))),
                                  lambda z: F.when(F.size(z["hits"]) > 0, spans(z)).otherwise(F.array().cast(SPAN))))
    return F.filter(found, lambda s: valid(s["value"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    back = F.reverse(digits(value))
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(back)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
        F.substring(back, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(back, i, F.lit(1)) >= "5", 9).otherwise(0)))
    return total % 10 == 0


def _no_spans() -> Column:
    return F.array().cast(SPAN)


def base_spans(text: Column) -> Column:
    """The contract's spans of a text, by start, then kind as listed."""
    count = lambda v: F.char_length(digits(v))
    email = F.when(F.contains(text, F.lit("@")), _found(text, EMAIL, "email", lambda v: F.lit(True), True)).otherwise(_no_spans())
    ip = F.when(text.rlike(r"[0-9]\.[0-9]+\.[0-9]"), _found(text, IP, "ip", lambda v: v.rlike(IP_VALID), True)).otherwise(_no_spans())
    card = F.when(text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), _found(text, CARD, "card", luhn, True)).otherwise(_no_spans())
    phone = F.when(text.rlike(r"\+[0-9]"), _found(text, PHONE, "phone", lambda v: count(v).between(9, 15), True)).otherwise(_no_spans())
    return F.sort_array(F.concat(email, ip, card, phone))


def wide_spans(text: Column, base: Column) -> Column:
    """Candidates of the wider patterns that overlap no base span."""
    found = [F.when(text.rlike(NEEDS[k]), _found(text, WIDE[k], k, lambda v: F.lit(True), False)).otherwise(_no_spans()) for k in WIDE]
    # a phone-like piece of a card-like candidate is part of it
    free = F.filter(F.concat(*found), lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return F.sort_array(free)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def judged(spans: Column, text: Column) -> Column:
    """Each span with its votes (format, check, list, cue, free) and its features."""
    def one(s):
        v, kind = s["value"], s["kind"]
        by = lambda cases: reduce(lambda acc, k: acc.when(kind == k, cases[k]), ALL_KINDS[1:], F.when(kind == ALL_KINDS[0], cases[ALL_KINDS[0]]))
        n = F.char_length(digits(v))
        key = F.regexp_extract(v, r"([A-Za-z0-9+/_.-]*=*)$", 1)  # a secret without its keyword and quote
        key = F.when(v.rlike("^AKIA[A-Z0-9]+$"), v).otherwise(key)
        mixed = key.rlike("[0-9]") & key.rlike("[A-Za-z]")
        strict = by({k: v.rlike(STRICT[k]) if k != "secret" else (F.char_length(key) >= 16) & key.rlike(STRICT[k]) for k in ALL_KINDS})
        tail = F.lower(F.regexp_extract(v, r"([A-Za-z]+)$", 1))
        check = by({"email": _vote(F.char_length(tail) >= 2, F.char_length(tail) < 2), "ip": _vote(v.rlike(IP_VALID), ~v.rlike(IP_VALID)),
                    "card": _vote(luhn(v), ~luhn(v)), "phone": _vote(n.between(9, 15), ~n.between(9, 15)),
                    "secret": _vote(mixed & (F.char_length(key) >= 12), ~mixed)})
        listed = by({"email": _vote(tail.rlike(f"^({DOMAINS})$"), ~tail.rlike(f"^({DOMAINS})$")),
                     "ip": _vote(~v.rlike(r"^(0|10|127|192\.168|22[4-9]|2[3-5][0-9])\."), v.rlike(r"^0\.")),
                     "card": _vote(digits(v).rlike(ISSUERS), ~digits(v).rlike(ISSUERS)),
                     "phone": _vote(v.rlike(COUNTRY), ~v.rlike(r"^[+(0-9]")),
                     "secret": _vote(key.rlike(KNOWN_KEYS), ~key.rlike("[0-9]"))})
        before = F.lower(F.substring(text, F.greatest(F.lit(1).cast("long"), s["start"] + 1 - CONTEXT).cast("int"), F.least(F.lit(CONTEXT).cast("long"), s["start"]).cast("int")))
        cue = by({k: _vote(before.rlike(CUES[k][0]), before.rlike(CUES[k][1])) for k in ALL_KINDS})
        left = F.when(s["start"] == 0, F.lit(" ")).otherwise(F.substring(text, s["start"].cast("int"), F.lit(1)))
        right = F.substring(text, (s["stop"] + 1).cast("int"), F.lit(1))
        stuck = left.rlike("[A-Za-z0-9]") | right.rlike("[A-Za-z0-9]")
        features = F.array(kind, F.concat(kind, F.lit(":length:"), F.least(F.floor(F.char_length(v) / 4), F.lit(8)).cast("string")),
                           F.concat(kind, F.lit(":digits:"), F.floor(F.lit(4) * n / F.char_length(v)).cast("string")),
                           F.concat(kind, F.lit(":marks:"), F.least(F.lit(3), F.char_length(F.regexp_replace(v, "[A-Za-z0-9]", ""))).cast("string")))
        votes = F.array(_vote(strict, ~strict), check, listed, cue, _vote(~stuck, stuck))
        return F.struct(s.alias("span"), votes.alias("votes"), features.alias("features"))

    return F.transform(spans, one)


VOTES = (-1, 0, 1)
LABELERS = 5


def _log(x: float) -> float:
    return math.log(max(x, 1e-12))


def fit(counts: DataFrame, rounds: int, prior: float) -> tuple[list[list[float]], dict[str, float], float]:
    """Labeler log-odds by vote, feature log-odds, prior log-odds, from (votes, features, n).

    Every round is one aggregation of the bounded ``counts`` table; a row of rates comes back.
    """
    # at first labelers are taken to be right 4 times in 5 (abstentions say nothing)
    odds = [[-math.log(4), 0.0, math.log(4)] for _ in range(LABELERS)]
    base = _log(prior) - _log(1 - prior)
    for _ in range(rounds):
        row = counts.select("votes", "n", _posterior(odds, base).alias("p")).agg(
            F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum("n").alias("n"),
            *(F.sum(F.when(F.col("votes")[i] == v, F.col("n") * F.col("p")).otherwise(0.0)).alias(f"y{i}_{v + 1}") for i in range(LABELERS) for v in VOTES),
            *(F.sum(F.when(F.col("votes")[i] == v, F.col("n") * (1 - F.col("p"))).otherwise(0.0)).alias(f"n{i}_{v + 1}") for i in range(LABELERS) for v in VOTES)).first()
        if not row["n"]:
            return odds, {}, base
        yes, no = row["yes"], row["n"] - row["yes"]
        # one pseudo-span a vote at the first guess keeps a class that never occurs from degenerating
        guess = {-1: (0.2, 0.6), 0: (0.2, 0.2), 1: (0.6, 0.2)}
        odds = [[_log((row[f"y{i}_{v + 1}"] + 5 * guess[v][0]) / (yes + 5)) - _log((row[f"n{i}_{v + 1}"] + 5 * guess[v][1]) / (no + 5)) for v in VOTES] for i in range(LABELERS)]
        base = _log((yes + 5) / (row["n"] + 10)) - _log((no + 5) / (row["n"] + 10))
    soft = counts.select(F.explode("features").alias("feature"), "n", _posterior(odds, base).alias("p"))
    table_ = soft.groupBy("feature").agg(F.sum(F.col("n") * F.col("p")).alias("y"), F.sum(F.col("n") * (1 - F.col("p"))).alias("m")).collect()  # bounded by the feature values
    yes, no = sum(r["y"] for r in table_) / 4, sum(r["m"] for r in table_) / 4
    weights = {r["feature"]: _log((r["y"] + 1) / (yes + 2)) - _log((r["m"] + 1) / (no + 2)) for r in table_}
    return odds, weights, base


def _votes_odds(votes: Column, odds: list[list[float]], base: float) -> Column:
    return reduce(lambda acc, i: acc + F.get(F.array(*map(F.lit, odds[i])), F.get(votes, F.lit(i)) + 1), range(LABELERS), F.lit(base))


def _posterior(odds: list[list[float]], base: float) -> Column:
    return 1 / (1 + F.exp(-_votes_odds(F.col("votes"), odds, base)))


def find_personal_data(docs: DataFrame, rounds: int = 8, prior: float = 0.5, accept: float = 0.9) -> DataFrame:
    """(doc_id, base, spans): arrays of spans of every row; ``spans`` are the base ones and those accepted beyond."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    texts = texts.select("doc_id", "text", "base", wide_spans(F.col("text"), F.col("base")).alias("wide"))
    spans = store(texts.select("doc_id", "base", judged(F.concat("base", "wide"), F.col("text")).alias("judged")), "spans")
    every = spans.select(F.explode("judged").alias("j"))
    counts = store(every.groupBy("j.votes", "j.features").agg(F.count("*").alias("n")), "votes")
    odds, weights, start = fit(counts, rounds, prior)
    known = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)) if weights else F.create_map().cast("map<string,double>")

    def accepted(j):
        # the votes and the classifier are two views of the span: their mean log-odds decides
        votes = _votes_odds(j["votes"], odds, start)
        model = F.aggregate(j["features"], F.lit(start), lambda acc, f: acc + F.coalesce(F.element_at(known, f), F.lit(0.0)))
        return ~j["span"]["base"] & (votes > 0) & (votes + model >= 2 * math.log(accept / (1 - accept)))

    more = F.transform(F.filter("judged", accepted), lambda j: j["span"])
    return spans.select("doc_id", "base", more.alias("more")).select("doc_id", "base", F.sort_array(F.concat("base", "more")).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


# ---------------------------------------------------------------- registered query

def op9_personal_data(spark, sf_dir):
    out = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = [_count(kind).alias("n_" + kind) for kind in KINDS]
    return out.select("doc_id", *kinds, F.sha2(F.encode(span_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
