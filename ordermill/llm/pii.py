"""Personal data: fixed patterns, and terms that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers with their offsets. The method then asks which
other terms disclose these entities: over all documents, a term t discloses an entity e as far as
PMI(e; t) / IC(e), the share of e's information that seeing t gives, with IC(e) = -log2 P(e). All counts (of e, of t, of
both together and of all) are of documents, with a document's whole text as the place where e and t stand together,
so copying every document changes no decision. Least support: a term must share at least `LEAST_TEXTS` different texts
with an entity; copies of one text are one of these, so what is only ever found in one or two texts discloses nothing.
Terms above `GENERALISE` are replaced by a general word, terms above `REMOVE` are removed, wherever they stand in the
documents of that entity.

All of it is built-in functions. Documents are read where they lie; only term counts, and the terms of distinct texts
that hold entities, are shuffled. Entities that are found in exactly the same texts have the same counts with every term, and
so have terms; pairs are therefore listed of classes, by a fingerprint of the set of texts (two 64-bit hashes, combined by
exclusive or), so a list of a thousand addresses is one entity to its terms. Pairs that are too frequent to disclose are left
out (which loses none), and tasks combine the others before they are shuffled. Offsets are added up in two levels, so a
text's cost is in proportion to its length and its matches.

Defined results: null text is empty (and stays null when texts are rewritten); terms are found and hidden by text, so rows
that repeat or lack an id are documents of their own; an empty table gives an empty result; other columns are kept by
`sanitise`, whatever they are called, and ignored otherwise.
"""

from __future__ import annotations

import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import lower_ascii, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# The four patterns. Parts that cannot match otherwise are possessive, and runs are only tried from
# where they begin (or where the last match ended), which finds the same matches in linear time.
_PART = r"(?:\.[A-Za-z0-9-]++)"
PATTERNS = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++{_PART}++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IP_PARTS = rf"\A{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}\z"
# What a text must hold for a pattern to be tried.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
LABELS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>", "drop": ""}

TERM = r"\p{L}{3,}"
LEAST_TEXTS = 3
GENERALISE = 0.8
REMOVE = 0.95
MATCHES = "array<struct<kind:string,start:int,end:int,value:string>>"
# Numbers that are added up by appending, and characters that are counted from the beginning, at a time.
RUN, CHUNK = 256, 4096
Add = Callable[[Column, Column], Column]


# --- arrays in one pass


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(values: Column, first: Column, add: Add) -> Column:
    """first + v1, first + v1 + v2, ...; the arrays that it appends to should be short."""
    start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, value: Column) -> Column:
        at = add(state["at"], value)
        return F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out"))

    return F.aggregate(values, start, step, lambda state: state["out"])


def running(values: Column, add: Add) -> Column:
    """Running totals of whole numbers from 0 under an associative operation, in runs of `RUN` and over the runs."""

    def of(all_: Column) -> Column:
        part = lambda r: F.slice(all_, r * RUN + 1, F.lit(RUN))
        runs = F.sequence(F.lit(0), ((F.size(all_) - 1) / RUN).cast("int"))
        totals = F.transform(runs, lambda r: F.aggregate(part(r), F.lit(0), add))
        before = F.concat(F.array(F.lit(0)), _scan(totals, F.lit(0), add))
        each = F.zip_with(runs, F.slice(before, F.lit(1), F.size(before) - 1), lambda r, b: _scan(part(r), b, add))
        return F.when(F.size(all_) > 0, F.flatten(each)).otherwise(F.array().cast("array<int>"))

    return _with(values, of)


# --- fixed patterns


def _matches(text: Column, pattern: Column, kind: Column) -> Column:
    """Matches as (kind, start, end, value): a match ends after all pieces and matches up to it."""
    found, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    moves = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda b, v: F.length(b) + F.length(v))
    return F.zip_with(
        running(moves, operator.add),
        found,
        lambda e, v: F.struct(kind.alias("kind"), (e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def added(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + added(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return F.rlike(value, F.lit(IP_PARTS))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_matches(text: Column) -> Column:
    """Array of (kind, start, end, value) by kind as in KINDS, then start."""
    none = F.array().cast(MATCHES)

    def of(kind: str) -> Column:
        found = _matches(text, F.lit(PATTERNS[kind]), F.lit(kind))
        valid = F.filter(found, lambda m: _valid(kind, m["value"]))
        return F.when(F.rlike(text, F.lit(SIGNS[kind])), valid).otherwise(none)

    return F.concat(*[of(kind) for kind in KINDS])


# --- disclosing terms


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def entities(text: Column) -> Column:
    """Distinct entities of a text as kind:value, the value in lower case or its digits alone."""

    def name(m: Column) -> Column:
        number = m["kind"].isin("card", "phone")
        return F.concat(m["kind"], F.lit(":"), F.when(number, _digits(m["value"])).otherwise(lower_ascii(m["value"])))

    return F.array_distinct(F.transform(base_matches(text), name))


def _digest() -> Column:
    return F.md5(text_or_empty().cast("binary")).alias("digest")


def holders(docs: DataFrame) -> DataFrame:
    """The distinct texts that hold entities: digest, n (documents with this text), entities and terms."""
    text = text_or_empty()
    row = lambda e: F.struct(_digest(), e.alias("entities"), terms(text).alias("terms"))
    holding = F.filter(F.array(entities(text)), lambda e: F.size(e) > 0)
    found = docs.select(F.inline(F.transform(holding, row)))
    once = [F.first(c).alias(c) for c in ("entities", "terms")]
    return stored(found.groupBy("digest").agg(F.count("*").alias("n"), *once), "pii-texts")


def by_holders(texts: DataFrame, column: str) -> DataFrame:
    """The values of an array column that enough texts hold: value, n (documents), and holders (number and fingerprint
    of the set of texts)."""
    each = texts.select("digest", "n", F.explode(column).alias("value"))
    prints = [F.bit_xor(F.xxhash64(F.lit(seed), "digest")) for seed in (1, 2)]
    counted = each.groupBy("value").agg(
        F.sum("n").alias("n"), F.struct(F.count("*").alias("n_texts"), prints[0].alias("x"), prints[1].alias("y")).alias("holders")
    )
    return counted.filter(F.col("holders.n_texts") >= LEAST_TEXTS)


def _classes(texts: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """digest, value, and the value's class."""
    each = texts.select("digest", F.explode(column).alias("value"))
    return stored(each.join(known, "value").select("digest", "value", "class"), name)


def disclosing(texts: DataFrame, frequency: DataFrame, n_docs: int) -> DataFrame:
    """digest, chosen: the terms of each text that disclose an entity in it, with the action ("term" to generalise,
    "drop" to remove). All counts are of documents.

    As n_both <= n_entity, a share of at least GENERALISE needs n_term <= n_entity * (N / n_entity) ** (1 - GENERALISE).
    """
    total = F.lit(float(n_docs))
    most = F.col("n") * F.pow(total / F.col("n"), 1 - GENERALISE) * (1 + 1e-9)
    entities_ = stored(by_holders(texts, "entities").withColumn("most", most), "pii-entities")
    limit = entities_.agg(F.max("most")).scalar()
    terms_ = by_holders(texts, "terms").join(frequency.withColumnRenamed("term", "value"), "value")
    terms_ = terms_.filter(F.col("n_term") <= limit).select("value", F.struct("holders.x", "holders.y", "n_term").alias("class"))
    entity_class = F.struct("holders.x", "holders.y", F.col("n").alias("n_entity"), "most").alias("class")
    of_entities = _classes(texts, "entities", entities_.select("value", entity_class), "pii-text-entities")
    # Only texts with an entity that can be disclosed have terms to look at.
    wanted = texts.join(of_entities.select("digest").distinct(), "digest", "left_semi")
    of_terms = _classes(wanted, "terms", stored(terms_, "pii-term-classes"), "pii-text-terms")
    e = of_entities.groupBy("digest").agg(F.collect_set("class").alias("es"))
    t = of_terms.groupBy("digest").agg(F.collect_set("class").alias("ts"))
    listed = texts.select("digest", "n").join(e, "digest").join(t, "digest")
    listed = listed.select("digest", "n", F.explode("es").alias("e"), "ts").select("digest", "n", "e", F.explode("ts").alias("t"))
    listed = listed.filter(F.col("t.n_term") <= F.col("e.most"))
    both = listed.groupBy("e", "t").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_texts"))
    both = both.filter(F.col("n_texts") >= LEAST_TEXTS)
    information = F.log2(total / F.col("e.n_entity"))
    pmi = F.log2(total * F.col("n_both") / (F.col("e.n_entity").cast("double") * F.col("t.n_term")))
    disclosed = F.when(information > 0, pmi / information)
    action = F.when(disclosed >= REMOVE, "drop").when(disclosed >= GENERALISE, "term")
    found = stored(both.select("e", "t", action.alias("action")).filter("action IS NOT NULL"), "pii-disclosing")
    chosen = listed.join(found, ["e", "t"]).select("digest", F.col("t").alias("class"), "action").distinct()
    chosen = of_terms.join(chosen, ["digest", "class"]).groupBy("digest")
    return stored(chosen.agg(F.collect_set(F.struct("action", F.col("value").alias("term"))).alias("chosen")), "pii-chosen")


def terms_by_text(docs: DataFrame) -> DataFrame:
    texts, n_docs = holders(docs), docs.count()
    frequency = docs.select(F.explode(terms(text_or_empty())).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    # Written down, sizes are known, and what is small need not be shuffled with what is large.
    frequency = stored(frequency.filter(F.col("n_term") >= LEAST_TEXTS), "pii-frequency")
    return disclosing(texts, frequency, n_docs)


def _term_matches(text: Column, base: Column, chosen: Column) -> Column:
    """Whole words that are chosen terms, outside of base matches, those to remove last."""

    def of(action: str) -> Column:
        own = F.transform(F.filter(chosen, lambda c: c["action"] == action), lambda c: c["term"])
        # A term that one entity removes and another generalises is removed.
        if action == "term":
            removed = F.transform(F.filter(chosen, lambda c: c["action"] == "drop"), lambda c: c["term"])
            own = F.array_except(own, removed)
        words = _matches(text, F.lit(TERM), F.lit(action))
        named = _with(own, lambda names: F.filter(words, lambda m: F.array_contains(names, F.lower(m["value"]))))
        outside = F.filter(named, lambda m: ~F.exists(base, lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])))
        return F.when(F.size(own) > 0, outside).otherwise(F.array().cast(MATCHES))

    return F.when(F.size(chosen) > 0, F.concat(of("term"), of("drop")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """`row` (all columns of `docs`), `base` (matches of the patterns) and `found` (these, then terms)."""
    chosen = terms_by_text(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), base_matches(text_or_empty()).alias("base"), _digest())
    more = _term_matches(text_or_empty("row.text"), F.col("base"), F.col("chosen"))
    found = F.concat("base", F.coalesce(more, F.array().cast(MATCHES)))
    return rows.join(chosen, "digest", "left").select("row", "base", found.alias("found"))


def span_list(matches: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(matches, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = find_personal_data(docs.select("doc_id", "text"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(span_list("base").cast("binary"), 256).alias("base_sha256")
    return found.select("row.doc_id", *map(number, KINDS), digest, span_list("found").alias("spans"))


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """Characters from start to end of a text given in chunks."""
    first, last = (start / CHUNK).cast("int"), (end / CHUNK).cast("int")
    around = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.substring(around, start - first * CHUNK + 1, end - start)


def rewritten(text: Column, matches: Column) -> Column:
    """The text with every match replaced by its label; of overlapping matches the first gives the label."""
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"], m["end"], m["kind"])))
    starts = F.sequence(F.lit(0), (F.length(text) / CHUNK).cast("int"))
    chunks = F.transform(starts, lambda i: F.substring(text, i * CHUNK + 1, F.lit(CHUNK)))

    def parts(ms: Column, cs: Column) -> Column:
        """What stands between the matches before and each match, and its label, if it begins after them."""

        def of(ends: Column) -> Column:
            def part(m: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
                kept = F.concat(_between(cs, before, m["start"]), label[m["kind"]])
                return F.when(m["start"] >= before, kept).otherwise("")

            rest = _between(cs, F.get(ends, F.size(ends) - 1), F.length(text))
            return F.concat(F.array_join(F.transform(ms, part), ""), rest)

        return _with(running(F.transform(ms, lambda m: m["end"]), lambda a, b: F.greatest(a, b)), of)

    done = _with(ordered, lambda ms: _with(chunks, lambda cs: parts(ms, cs)))
    return F.when(F.size(matches) > 0, done).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows with personal data replaced in `text`."""
    clean = rewritten(F.col("row.text"), F.col("found"))
    return find_personal_data(docs).select(*[(clean if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
