"""Personal data by weak supervision, in DataFrame and SQL functions only.

Regular expressions give the base spans, which always stay, and looser candidates. Labelers vote
for or against every candidate or abstain: words before and after it, the label of its line, its
format and checksum, its distinct characters, ranges reserved for examples, its neighbouring
characters. None of them repeats the base rule, and each has cases of its own, so they disagree.
Expectation-maximisation estimates how reliable each labeler is from the counts of vote patterns.
A logistic classifier that sees no votes but the span and its surroundings (length, separators,
checksum, the words before and after) is trained on the posteriors; candidates that it accepts
are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base spans. Possessive quantifiers and look-behinds keep the
# leftmost matches as they are, and make the search linear in the text.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+])(?<![0-9)][\x20().-])(?<![0-9][\x20().-]\()\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])",
}
# Cue words before a span, for its kind and against any kind.
CUES = {
    "email": "mail|e-mail|contact|write|schreib|courriel|correo|kontakt",
    "ip": "ip|host|server|address|adresse|dirección|login",
    "card": "card|visa|mastercard|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|telefon|téléphone|teléfono|móvil|handy",
}
# Words after a span, for its kind and against any kind.
FOLLOWING = {
    "email": "for details|for more|anytime",
    "ip": "port|responded|logged|timed",
    "card": "exp|expires|cvv|cvc|valid",
    "phone": "ext|extension|anytime|durchwahl",
}
AGAINST = "isbn|issn|version|order|invoice|serial|sku|part|ref|doi|build|hash"
UNITS = "usd|eur|pages|items|units|pieces|kg|bytes|edition"
# Ranges that are set aside for examples and tests.
RESERVED = {
    "email": r"(?i)(?:example\.(?:com|org|net)|\.(?:test|invalid|example))$",
    "ip": r"^(?:0|127|192\.0\.2|198\.51\.100|203\.0\.113)\.|^2001:0?db8:",
    "card": r"^(?:4111 ?-?1111 ?-?1111 ?-?1111|4242 ?-?4242 ?-?4242 ?-?4242|5555 ?-?5555 ?-?5555 ?-?4444)$",
    "phone": r"555[\x20.-]?01[0-9]{2}$",
}
CONTEXT = 40
LABELERS = ("before", "against", "label", "after", "form", "distinct", "reserved", "edge")
EM_ROUNDS = 30
FIT_ROUNDS = 200
BALANCE = 0.5  # without votes, a candidate is never more likely right than wrong
ACCEPT = 0.5
LENGTHS = (9, 13, 17, 24)  # classes of span lengths end before these
SEPARATORS = ("", " ", "-", ".", "(")
WORDS_BEFORE, WORDS_AFTER = 16, 8  # classes of the words next to a span: none, those of the gazetteers, hashes of others
SIZES = (1, len(LENGTHS) + 1, len(SEPARATORS) + 1, 3, WORDS_BEFORE, WORDS_AFTER)
SPAN = "array<struct<start:int,end:int,said:string>>"


def _spans(text: Column, matches: Column, pattern: str) -> Column:
    """Start, end and string of each match, counted in characters from the pieces between the matches."""
    empty = F.array().cast(SPAN)
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    merged = F.aggregate(
        F.arrays_zip(between.alias("gap"), matches.alias("said")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["said"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(x["gap"])).alias("start"),
                        (acc["at"] + F.length(x["gap"]) + F.length(x["said"])).alias("end"),
                        x["said"].alias("said"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(F.size(matches) > 0, merged).otherwise(empty)


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _luhn(said: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right, every second digit counts double, less 9 if above 9."""
    digits = F.split(F.reverse(_digits(said)), "")
    values = F.transform(
        digits,
        lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)),
    )
    return F.aggregate(values, F.lit(0), lambda s, v: s + v) % 10 == 0


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _valid(kind: str, said: Column) -> Column:
    """Whether a match is a base span."""
    n = F.length(_digits(said))
    return {
        "email": F.lit(True),
        "ip": said.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.when(n.between(16, 19), _luhn(said)).otherwise(False),
        "phone": n.between(8, 15),
    }[kind]


def _is_base(kind: str):
    return lambda s: _valid(kind, s["said"])


def _of_kind(kind: str):
    return lambda s: s["strict"] & (s["kind"] == kind)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, F.lit(1)).when(bad, F.lit(-1)).otherwise(F.lit(0))


def _candidates(kind: str, text: Column, base: Column, matches: Column, loose: Column | None) -> Column:
    """Every candidate of a kind with its votes, as one array; traits are the places of its features in the classifier's weights."""
    digits = {"card": (13, 19), "phone": (7, 20)}.get(kind)  # matches that fail for another reason can't be of the kind
    others = F.filter(matches, lambda s: ~_valid(kind, s["said"]) & F.length(_digits(s["said"])).between(*digits) if digits else F.lit(False))
    found = F.concat(F.transform(base, lambda s: F.struct(s["start"], s["end"], s["said"], F.lit(True).alias("strict"))), F.transform(others, lambda s: F.struct(s["start"], s["end"], s["said"], F.lit(False).alias("strict"))))
    if loose is not None:
        found = F.concat(found, F.transform(loose, lambda s: F.struct(s["start"], s["end"], s["said"], F.lit(False).alias("strict"))))

    def judged(s: Column) -> Column:
        start, end, said = s["start"], s["end"], s["said"]
        line = F.lower(text.substr(F.greatest(start - 2 * CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(2 * CONTEXT))))
        ahead = F.substring(line, -CONTEXT, CONTEXT)
        behind = F.lower(text.substr(end + 1, F.lit(CONTEXT)))
        label = F.regexp_extract(line, r"(?:^|[\n|])[\x20*-]*([\p{L}.\x20-]{2,24}):[^\n|:]*$", 1)
        others = "|".join([AGAINST, *(c for k, c in CUES.items() if k != kind)])
        n = F.length(_digits(said))
        form = {
            "email": _vote(said.rlike(r"[.\x20)\]][A-Za-z]{2,6}$"), ~said.rlike(r"[A-Za-z]$")),
            "ip": _vote(said.contains(":"), said.rlike(r"^0|\.0[0-9]")),
            "card": _vote(n.between(15, 19) & _luhn(said), ~_luhn(said)),
            "phone": _vote(n.between(10, 15) & _digits(said).rlike("[2-9][0-9]{2}[2-9][0-9]{6}$"), ~n.between(8, 15)),
        }[kind]
        core = F.split(said, "@")[0] if kind == "email" else _digits(said)
        distinct = F.size(F.array_distinct(F.split(core, "")))
        before, after = text.substr(start, F.lit(1)), F.substring(behind, 1, 1)
        never = F.lit(False)
        votes = {
            "before": _vote(ahead.rlike(rf"\b(?:{CUES[kind]})\b"), never),
            "against": _vote(never, ahead.rlike(rf"\b(?:{AGAINST})\b")),
            "label": _vote(label.rlike(rf"\b(?:{CUES[kind]})\b"), label.rlike(rf"\b(?:{others})\b")),
            "after": _vote(behind.rlike(rf"^[\x20,(]*(?:{FOLLOWING[kind]})\b"), behind.rlike(rf"^\x20?(?:{UNITS})\b")),
            "form": form,
            "distinct": _vote(never, distinct <= F.lit(1 if kind == "email" else 2)),
            "reserved": _vote(never, said.rlike(RESERVED[kind])),
            "edge": _vote(never, ((start > 0) & before.rlike(r"[\p{L}0-9_]")) | after.rlike(r"^[\p{L}0-9_]")),
        }
        length = sum(((end - start >= at).cast("int") for at in LENGTHS), F.lit(0))
        marks = F.array_distinct(F.filter(F.split(F.regexp_replace(said, r"[^\x20().-]", ""), ""), lambda m: m != ""))
        separators = F.when(F.array_contains(marks, "("), SEPARATORS.index("(")).when(F.size(marks) > 1, len(SEPARATORS))
        separators = separators.otherwise(F.array_position(F.array(*map(F.lit, SEPARATORS)), F.array_join(marks, "")).cast("int") - 1)
        word_before = F.regexp_extract(ahead, r"([\p{L}]+)[^\p{L}]*$", 1)
        word_after = F.regexp_extract(behind, r"^[^\p{L}]*([\p{L}]+)", 1)

        def classed(word: Column, known: list[str], classes: int) -> Column:
            first = 1 + len(known)
            at = F.when(word == "", 0)
            for k, words in enumerate(known):
                at = at.when(word.rlike(rf"^(?:{words})$"), 1 + k)
            return at.otherwise(first + F.pmod(F.xxhash64(word), F.lit(classes - first)).cast("int"))

        words = [classed(word_before, [CUES[kind], AGAINST, others], WORDS_BEFORE), classed(word_after, [FOLLOWING[kind], UNITS], WORDS_AFTER)]
        seen = [F.lit(0), length, separators, form + 1, *words]
        traits = F.array(*((F.lit(sum(SIZES[:at])) + v).cast("int") for at, v in enumerate(seen)))
        return F.struct(start.alias("start"), end.alias("end"), s["strict"].alias("strict"), F.array(*(votes[name] for name in LABELERS)).alias("votes"), traits.alias("traits"))

    return F.transform(found, judged)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one more column, __pii: for each kind the array of (start, end, strict, votes, traits)."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    where = {"email": said.contains("@"), "phone": said.contains("+")}
    hint = {"email": said.contains("at)") | said.contains("at]"), "ip": said.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"), "phone": said.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")}
    none = F.array().cast("array<string>")
    every = {k: (p, where.get(k)) for k, p in PATTERNS.items()} | {f"{k}_loose": (p, hint[k]) for k, p in LOOSE.items()}
    found = {n: F.regexp_extract_all(said, F.lit(p), F.lit(0)) for n, (p, _) in every.items()}
    out = docs.select(*keep, *((F.when(c, found[n]).otherwise(none) if c is not None else found[n]).alias(f"__{n}") for n, (_, c) in every.items()))
    out = out.select(*keep, *(_spans(said, F.col(f"__{n}"), p).alias(f"__{n}") for n, (p, _) in every.items()))
    base = {k: F.filter(F.col(f"__{k}"), _is_base(k)) for k in KINDS}
    arrays = [_candidates(k, said, base[k], F.col(f"__{k}"), F.col(f"__{k}_loose") if k in LOOSE else None).alias(k) for k in KINDS]
    return out.select(*keep, F.struct(*arrays).alias("__pii"))


POSTERIOR = "1 / (1 + exp(-(ln(m.pi / (1 - m.pi)) + aggregate(zip_with(p.v, m.a, (v, a) -> v * ln(a / (1 - a))), 0D, (s, y) -> s + y))))"


def reliabilities(patterns: DataFrame, labelers: int = len(LABELERS)) -> DataFrame:
    """kind, m (pi: share of right candidates; a: how often each labeler is right when it votes), pats (v, n, q).

    patterns: kind, votes (-1, 0, 1 for each labeler), n. q is the posterior of a pattern. There are at most
    3 ** labelers patterns of a kind at any input size, so the rounds run over an array of them in one row.
    A labeler counts as better than chance; pi is at most BALANCE.
    """
    pats = F.array_sort(F.collect_list(F.struct(F.col("votes").alias("v"), F.col("n").cast("double").alias("n"))))
    step = f"""
      transform(array(transform(pats, p -> named_struct('v', p.v, 'n', p.n, 'q', {POSTERIOR}))), r -> named_struct(
        'pi', least({BALANCE}D, aggregate(r, 1D, (s, e) -> s + e.n * e.q) / aggregate(r, 2D, (s, e) -> s + e.n)),
        'a', transform(sequence(0, {labelers - 1}), l -> least(0.99D, greatest(0.51D,
          aggregate(r, 4D, (s, e) -> s + e.n * CASE e.v[l] WHEN 1 THEN e.q WHEN -1 THEN 1 - e.q ELSE 0D END)
          / aggregate(r, 5D, (s, e) -> s + e.n * abs(e.v[l])))))))[0]"""
    em = f"aggregate(sequence(1, {EM_ROUNDS}), named_struct('pi', {BALANCE}D, 'a', array_repeat(0.8D, {labelers})), (m, i) -> {step})"
    rows = patterns.groupBy("kind").agg(pats.alias("pats")).withColumn("m", F.expr(em))
    return rows.select("kind", "m", F.expr(f"transform(pats, p -> named_struct('v', p.v, 'n', p.n, 'q', {POSTERIOR}))").alias("pats"))


def trained(soft: DataFrame) -> DataFrame:
    """kind, w: weights of a logistic classifier. soft: kind, traits (places of a row's features), n, q (share of right ones).

    Rows of a kind are at most the product of SIZES at any input size, so all rounds run over an array of them.
    """
    width = sum(SIZES)
    rows = F.array_sort(F.collect_list(F.struct(F.col("traits").alias("x"), F.col("n").cast("double").alias("n"), F.col("q").alias("q"))))
    missed = "transform(soft, r -> named_struct('x', r.x, 'd', r.n * (r.q - 1 / (1 + exp(-aggregate(r.x, 0D, (s, j) -> s + w[j]))))))"
    slope = "aggregate(g, 0D, (s, e) -> s + if(array_contains(e.x, l), e.d, 0D))"
    step = f"transform(array({missed}), g -> transform(sequence(0, {width - 1}), l -> w[l] + {slope} / total - 0.001D * w[l]))[0]"
    fit = f"aggregate(sequence(1, {FIT_ROUNDS}), array_repeat(0D, {width}), (w, i) -> {step})"
    gathered = soft.groupBy("kind").agg(rows.alias("soft"), F.sum(F.col("n").cast("double")).alias("total"))
    return gathered.select("kind", F.expr(fit).alias("w"))


def fitted(found: DataFrame) -> DataFrame:
    """kind, w: the classifier's weights for every kind that has candidates."""
    every = [F.transform(F.col(f"__pii.{k}"), lambda c: F.struct(F.lit(k).alias("kind"), c["votes"].alias("votes"), c["traits"].alias("traits"))) for k in KINDS]
    counts = found.select(F.explode(F.concat(*every)).alias("c")).groupBy("c.kind", "c.votes", "c.traits").agg(F.count("*").alias("n"))
    judged = reliabilities(counts.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    posterior = judged.select("kind", F.explode("pats").alias("p")).select("kind", F.col("p.v").alias("votes"), F.col("p.q").alias("q"))
    soft = counts.join(posterior, ["kind", "votes"]).groupBy("kind", "traits").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("q")) / F.sum("n")).alias("q"))
    return trained(soft)


def weights(found: DataFrame) -> dict[str, list[float]]:
    """The classifier: some dozens of numbers for each kind at any input size."""
    return {r.kind: list(r.w) for r in fitted(found).collect()}


def _kept_spans(learned: dict[str, list[float]]) -> Column:
    """Base and added spans of all kinds: kind, start, end, strict; in order of kind, then start."""
    base = F.concat(*(F.filter(F.col(f"__pii.{k}"), lambda c: c["strict"]) for k in KINDS))

    def accepts(kind: str, traits: Column) -> Column:
        w = F.array(*map(F.lit, learned.get(kind, [0.0] * sum(SIZES))))
        logit = F.aggregate(traits, F.lit(0.0), lambda s, at: s + F.get(w, at))
        return 1 / (1 + F.exp(-logit)) > ACCEPT

    def of(kind: str) -> Column:
        added = F.filter(
            F.col(f"__pii.{kind}"),
            lambda c: c["strict"] | (accepts(kind, c["traits"]) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))),
        )
        return F.transform(F.array_sort(added), lambda c: F.struct(F.lit(kind).alias("kind"), c["start"], c["end"], c["strict"]))

    return F.concat(*map(of, KINDS))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text", keep=lambda df: df) -> DataFrame:
    """doc_id, spans (array of kind, start, end, strict) of every row; offsets count characters, end exclusive.

    strict marks base spans. Null texts count as empty; repeated rows stay; an empty table gives no
    rows; further columns are not read. `keep` may store the candidates so that texts are read once.
    """
    found = keep(candidates(docs.select(F.col(id).alias(id), F.col(text).alias("__text")), "__text").drop("__text"))
    return found.select(id, _kept_spans(weights(found)).alias("spans"))


def pii_digest(docs: DataFrame, keep=lambda df: df) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = find_pii(docs, keep=keep)
    base = F.filter("spans", lambda s: s["strict"])
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs, columns as they are, with every span in the text replaced by its kind in square brackets.

    Null texts stay null. Columns may have any names, those that this module gives to its own included.
    """
    longest = "c" * max(map(len, docs.columns))
    names = {c: f"{longest}{k}" if c.startswith("__") else c for k, c in enumerate(docs.columns)}
    if any(c != n for c, n in names.items()):
        other = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
        return redacted(other, names[text]).select(*(F.col(f"`{n}`").alias(c) for c, n in names.items()))
    found = candidates(docs, text)
    spans = F.array_sort(F.transform(_kept_spans(weights(found)), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    said = F.col(f"`{text}`")
    pieces = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(said.substr(acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), said.substr(acc["at"] + 1, F.length(said))),
    )
    marked = found.withColumn("__spans", spans)
    changed = F.when(F.size("__spans") > 0, pieces).otherwise(said)
    return marked.select(*(changed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
