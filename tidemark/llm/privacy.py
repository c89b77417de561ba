r"""Personal data: patterns, and terms that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers; these kinds are the
protected entities. The corpus then says how much every term reveals of them: with ``N``
documents, ``n_c`` with entity ``c``, ``n_t`` with term ``t`` and ``n_tc`` with both, pointwise
mutual information ``log2(n_tc N / (n_t n_c))`` over the entity's own information ``log2(N / n_c)``
is the share of it that the term discloses (1: the term alone implies the entity). A term
disclosing at least ``generalise`` of some entity is replaced by that entity's class, one of at
least ``remove`` is taken out. Counts are of all documents, whole texts, each term once a document.

Only terms that occur in at least ``support`` different texts with the entity can be judged, whatever
its values are there: copies of one document, however many, say nothing about a term. So
candidates come from the texts with entities, each taken once with the number of its documents;
what they are in all documents is counted in one more pass.

Everything is built-in expressions. Patterns are written with possessive quantifiers, so long
runs neither recurse nor backtrack.

A term that discloses two entities equally is counted to the later one in ``KINDS``; its spans and
what becomes of it are the same. Names that stand beside an entity in fewer than ``support`` texts
are not judged and stay.

Rows: a NULL text is empty and has no span. Repeated rows count as documents each. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_enough, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Letters with their combining marks, digits and underscores make a word.
IN_WORD = r"\p{L}\p{M}\p{N}_"
#: A local part starts where its run starts, or right behind the match before it.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
PATTERNS = {
    "email": EMAIL,
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "array<struct<kind:int,start:int,end:int>>"
MAX_LITERAL_TERMS, MAX_BROADCAST_TERMS = 2_000, 500_000
BLOCK = 512


def _matches(text: Column, pattern: Column) -> Column:
    """``array<struct<start, end, text>>`` of all matches, in code points.

    The text is split at the matches; lengths of gaps and matches are added up, block by block so
    that the work follows the number of matches and not its square.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    pairs = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("text"), g.alias("gap")))
    pairs = F.slice(pairs, 1, F.size(found))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(found) - 1) / BLOCK), F.lit(0))),
        lambda b: F.slice(pairs, (b * BLOCK + 1).cast("int"), BLOCK),
    )
    kind = "array<struct<start:int,end:int,text:string>>"

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.char_length(pair["text"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), pair["text"].alias("text")))
        return F.struct(end.alias("at"), F.concat(acc["all"], one.cast(kind)).alias("all"))

    def add_block(acc: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("all")), add)
        return F.struct(inner["at"].alias("at"), F.concat(acc["all"], F.array(inner["all"])).alias("all"))

    whole = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("all"))
    return F.flatten(F.aggregate(blocks, whole, add_block)["all"])


def _holds(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.char_length(digits)
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"),
        "card": count.between(13, 19) & F.when(count.between(13, 19), F.call_function("luhn_check", digits)),
        "phone": count.between(9, 15),
    }[kind]


def _spans_of(text: Column, number: int, kind: str) -> Column:
    held = F.filter(_matches(text, F.lit(PATTERNS[kind])), lambda m: _holds(kind, m["text"]))
    return _as_spans(held, number)


def _as_spans(matches: Column, number: int) -> Column:
    one = lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    return F.transform(matches, one).cast(SPAN)


def _of_kind(number: int):
    return lambda span: span["kind"] == number


def base_spans(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` by kind as in ``KINDS``, then start."""
    none = F.array().cast(SPAN)
    parts = [F.when(text.rlike(NEEDS[k]), _spans_of(text, n, k)).otherwise(none) for n, k in enumerate(KINDS)]
    return F.concat(*parts)


def outside(text: Column, base: Column) -> Column:
    """``text`` with a blank for every character of its base spans."""
    ordered = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def put(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["at"], span["end"])
        start = F.greatest(acc["at"], span["start"])
        between = F.substr(text, acc["at"] + 1, start - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], between, F.repeat(F.lit(" "), end - start)).alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    # one lambda variable, so that the spans are put once
    whole = F.transform(F.array(done), lambda d: F.concat(d["out"], F.substr(text, d["at"] + 1, F.char_length(text))))[0]
    return F.when(F.size(base) == 0, text).otherwise(whole)


def terms(text: Column, base: Column) -> Column:
    """The distinct lower-cased words of a text outside its base spans.

    Words are parted before they are lower-cased, as the case of a letter may hang on its neighbours.
    """
    return F.array_distinct(F.transform(_spellings(text, base), F.lower))


def _spellings(text: Column, base: Column) -> Column:
    """The distinct words of a text outside its base spans, as they are written."""
    return F.array_remove(F.array_distinct(F.split(outside(text, base), f"[^{IN_WORD}]+")), "")


def disclosing_terms(keyed: DataFrame, generalise: float = 0.6, remove: float = 0.85, support: int = 10) -> DataFrame:
    """``(term, kind, disclosure, removed)``: for each term at the threshold its most disclosed entity.

    ``keyed(text, base)`` are all documents with their spans.
    """
    has = [F.exists("base", _of_kind(n)) for n in range(len(KINDS))]
    totals = keyed.agg(F.count("*").alias("docs"), *[F.count_if(h).alias(f"docs_{k}") for h, k in zip(has, KINDS, strict=True)])
    texts = keyed.where(F.size("base") > 0).groupBy("text", "base", *[h.alias(k) for h, k in zip(has, KINDS, strict=True)]).agg(F.count("*").alias("docs"))
    private = texts.select("docs", *KINDS, F.explode(terms(F.col("text"), F.col("base"))).alias("term"))
    both = [F.sum(F.when(F.col(k), F.col("docs")).otherwise(0)).alias(k) for k in KINDS]
    counted = private.groupBy("term").agg(*both, *[F.count_if(k).alias(f"{k}_texts") for k in KINDS])
    candidates = counted.where(F.greatest(*[F.col(f"{k}_texts") for k in KINDS]) >= support)
    candidates = stored(candidates, "candidates")
    judged = F.broadcast(candidates) if small_enough(candidates, MAX_BROADCAST_TERMS) else candidates
    everywhere = keyed.select(F.explode(terms(F.col("text"), F.col("base"))).alias("term"))
    counts = everywhere.join(judged.select("term"), "term").groupBy("term").agg(F.count("*").alias("n"))
    # one row of totals, known by construction: broadcasting it is bounded
    table = candidates.join(counts, "term").crossJoin(F.broadcast(totals))
    shares = []
    for number, kind in enumerate(KINDS):
        own, both = F.col(f"docs_{kind}"), F.col(kind)
        information = F.log2(F.col("docs") / own)
        mutual = F.log2(both * F.col("docs") / (F.col("n") * own))
        share = F.when((F.col(f"{kind}_texts") >= support) & (own < F.col("docs")), mutual / information)
        shares.append(F.struct(F.coalesce(share, F.lit(-1.0)).alias("disclosure"), F.lit(number).alias("kind")))
    best = table.select("term", F.array_max(F.array(*shares)).alias("best")).select("term", "best.*")
    return best.where(F.col("disclosure") >= generalise).withColumn("removed", F.col("disclosure") >= remove)


def _term_spans(text: Column, base: Column, told: Column) -> Column:
    """Spans of the words of ``told``, an array of lower-cased words, outside the base spans.

    They are searched as the text spells them: folding case in a pattern would miss a word such as
    one with a dotted capital I, whose lower case has a character more. Spellings hold no sign that
    means anything to a pattern.
    """
    written = F.filter(_spellings(text, base), lambda w: F.array_contains(told, F.lower(w)))
    pattern = F.concat(F.lit(f"(?<![{IN_WORD}])(?:"), F.array_join(written, "|"), F.lit(f")(?![{IN_WORD}])"))
    return _as_spans(_matches(outside(text, base), pattern), len(KINDS))


def found(docs: DataFrame, generalise: float = 0.6, remove: float = 0.85, support: int = 10) -> DataFrame:
    """``(doc_id, text, base, spans, sanitised)`` per row; ``spans`` are ``base`` and those of terms."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("_row"))
    keyed = stored(rows.withColumn("base", base_spans(F.col("text"))), "spans")
    told = stored(disclosing_terms(keyed, generalise, remove, support), "terms")
    none = F.array().cast(SPAN)
    if small_enough(told, MAX_LITERAL_TERMS):
        known = {r.term: (r.kind, r.removed) for r in told.collect()}
        names = sorted(known)
        inside = F.filter(terms(F.col("text"), F.col("base")), lambda w: w.isin(names)) if names else F.array().cast("array<string>")
        joined = keyed.withColumn("_in", inside)
        gone = [w for w in names if known[w][1]]
        dropped = (lambda w: w.isin(gone)) if gone else (lambda w: F.lit(False))
    else:
        judged = F.broadcast(told) if small_enough(told, MAX_BROADCAST_TERMS) else told
        each = keyed.select("_row", F.explode(terms(F.col("text"), F.col("base"))).alias("term")).join(judged, "term")
        per_row = each.groupBy("_row").agg(F.collect_list("term").alias("_in"), F.collect_list(F.when(F.col("removed"), F.col("term"))).alias("_gone"))
        joined = keyed.join(per_row, "_row", "left")
        dropped = lambda w: F.coalesce(F.array_contains("_gone", w), F.lit(False))
    spans = F.when(F.size("_in") > 0, _term_spans(F.col("text"), F.col("base"), F.col("_in"))).otherwise(none)
    both = joined.withColumn("spans", F.concat("base", spans))
    return both.select("doc_id", "text", "base", "spans", sanitised(F.col("text"), F.col("spans"), dropped).alias("sanitised"))


def sanitised(text: Column, spans: Column, dropped) -> Column:
    """``text`` with base spans replaced by their class, terms generalised or taken out."""
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM)])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def put(acc: Column, span: Column) -> Column:
        inside = F.substr(text, span["start"] + 1, span["end"] - span["start"])
        gone = (span["kind"] == len(KINDS)) & dropped(F.lower(inside))
        label = F.when(gone, "").otherwise(F.element_at(labels, span["kind"] + 1))
        between = F.substr(text, acc["at"] + 1, span["start"] - acc["at"])
        later = F.struct(span["end"].alias("at"), F.concat(acc["out"], between, label).alias("out"))
        covered = F.struct(F.greatest(acc["at"], span["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(span["start"] >= acc["at"], later).otherwise(covered)

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], F.substr(text, done["at"] + 1, F.char_length(text))))


def told(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the order of the array."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digests(result: DataFrame) -> DataFrame:
    """Counts per kind and the spans of ``found`` as text."""
    counts = [
        F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS)
    ]
    return result.select("doc_id", *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
