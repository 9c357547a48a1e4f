"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Well-formed identifiers (e-mail, IP address, card, phone) are seeds.  The words in front of an identifier-like
token are a lexical pattern.  Patterns and instances form a graph, scored in turns: a pattern's confidence for
a kind is the smoothed share of its instances that are trusted as that kind, an instance's trust is the
noisy-or of its patterns (seeds: 1).  Patterns with enough confidence and support mark the other
identifier-like tokens they introduce.

The expressions below accept what the plain ones in the docstring of ``find`` accept, but start only where a
match can start and never give back, so long runs of digits or letters cost linear time and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.scale import durable

KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Identifier-like tokens: a digit or an at sign within a run of visible characters.
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Groups of a number written with single spaces: one that may be followed, and one that may follow.
_LEADS = r"^[+(\[]*+[0-9](?:[0-9()\[\].-]*[0-9)\]-])?$"
_FOLLOWS = r"^[(\[-]*+[0-9][0-9()\[\].-]*+[^\p{L}0-9@+]*+$"
_FOUND = "struct<kind:string,start:int,end:int,value:string,context:string,spaced:boolean>"

ROUNDS = 3
CONFIDENCE = 0.6
SUPPORT = 3
SMOOTHING = 2.0
#: Characters before a token in which its two words of context are looked for.
CONTEXT_CHARS = 60


def _context(before: Column) -> Column:
    """Last two words before a token, lower-cased, digits made equal; empty at the start of a text."""
    near = F.lower(F.regexp_replace(before, "[0-9]", "0"))
    words = F.filter(F.split(near, r"\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), " ")


def _located(text: Column, pattern: str, kind: str | None) -> Column:
    """Matches of ``pattern`` with start and end in code points, from the gaps between them.

    ``spaced`` tells whether a single space parts a match from the one before.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        # Earlier matches are text before this one like any other.
        before = F.right(F.concat(state["before"], pair["gap"]), F.lit(CONTEXT_CHARS))
        found = F.struct(
            F.lit(kind).cast("string").alias("kind"), start.alias("start"), end.alias("end"),
            pair["value"].alias("value"), _context(before).alias("context"), (pair["gap"] == " ").alias("spaced"),
        )
        past = F.right(F.concat(before, pair["value"]), F.lit(CONTEXT_CHARS))
        return F.struct(end.alias("at"), past.alias("before"), F.concat(state["out"], F.array(found)).alias("out"))

    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("value")))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.array().cast(f"array<{_FOUND}>").alias("out"))
    return F.aggregate(pairs, begin, step, lambda state: state["out"])


def _whole(tokens: Column) -> Column:
    """Tokens with the groups of a number written with single spaces put together; the first gives the context."""
    fields = [f.split(":") for f in _FOUND[len("struct<"):-1].split(",")]

    def step(state: Column, token: Column) -> Column:
        last = state["last"]
        joins = F.coalesce(
            token["spaced"] & (token["start"] == last["end"] + 1) & state["leads"] & token["value"].rlike(_FOLLOWS),
            F.lit(False),
        )
        new = {"end": token["end"], "value": F.concat(last["value"], F.lit(" "), token["value"])}
        merged = F.struct(*[new.get(name, last[name]).alias(name) for name, _ in fields])
        done = F.when(joins | last.isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(last)))
        return F.struct(
            done.alias("out"), F.when(joins, merged).otherwise(token).cast(_FOUND).alias("last"),
            token["value"].rlike(_LEADS).alias("leads"),
        )

    begin = F.struct(
        F.array().cast(f"array<{_FOUND}>").alias("out"), F.lit(None).cast(_FOUND).alias("last"), F.lit(False).alias("leads")
    )
    return F.aggregate(
        tokens, begin, step,
        lambda state: F.when(state["last"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(state["last"]))),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, at, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(at % 2 == 1, digit).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _octets(value: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(short) <= 3) & (F.substr(short, F.lit(1), F.lit(3)).cast("int") <= 255)

    return F.forall(F.split(value, r"\."), small)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return _octets(value)
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _valid_spans(kind: str) -> Column:
    return F.filter(_located(F.col("text"), _PATTERNS[kind], kind), lambda x: _valid(kind, x["value"]))


def located(docs: DataFrame) -> DataFrame:
    """``doc_id, row, base, tokens``: valid spans by kind and start, and identifier-like tokens outside them.

    Numbers written with single spaces are one token.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = F.array().cast(f"array<{_FOUND}>")
    needs = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    digit = F.col("text").rlike("[0-9]")
    found = rows.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row"),
        *[
            F.when(needs.get(kind, digit), _valid_spans(kind)).otherwise(none).alias(kind)
            for kind in KINDS
        ],
        F.when(digit | needs["email"], _located(F.col("text"), _TOKEN, None)).otherwise(none).alias("tokens"),
    )
    found = found.select("doc_id", "row", F.concat(*KINDS).alias("base"), "tokens")
    free = F.filter(
        "tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return found.select("doc_id", "row", "base", _whole(free).alias("tokens"))


def patterns(found: DataFrame) -> DataFrame:
    """``context, kind, confidence`` of the patterns that may mark new identifiers."""
    seen = found.select(F.explode(F.concat("base", "tokens")).alias("x")).where("x.context != ''")
    edges = durable(
        seen.groupBy(F.col("x.context").alias("context"), F.lower("x.value").alias("instance"))
        .agg(F.max("x.kind").alias("seed"))
    )
    sizes = edges.groupBy("context").agg(F.count(F.lit(1)).alias("instances"), F.count("seed").alias("seeds"))
    # A pattern without a seed can only gain trust through instances shared with one; single uses teach nothing.
    sizes = durable(sizes.where("instances > 1"))
    edges = durable(edges.join(sizes.select("context", "instances"), "context"))
    trust = edges.where("seed is not null").groupBy("instance", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("trust"))
    scored = None
    for _ in range(ROUNDS):
        trusted = edges.join(trust, "instance")
        scored = durable(
            trusted.groupBy("context", "kind").agg(
                (F.sum("trust") / (F.max("instances") + SMOOTHING)).alias("confidence"),
                F.sum(F.when(F.col("trust") >= CONFIDENCE, 1).otherwise(0)).alias("support"),
            )
        )
        doubt = edges.where("seed is null").join(scored, "context").groupBy("instance", "kind").agg(
            F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))).alias("doubt")
        )
        seeds = edges.where("seed is not null").groupBy("instance", F.col("seed").alias("kind")).agg(
            F.lit(-100.0).alias("doubt")
        )
        trust = durable(
            doubt.union(seeds).groupBy("instance", "kind").agg((1 - F.exp(F.sum("doubt"))).alias("trust"))
        )
    best = scored.where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
    return best.groupBy("context").agg(F.max(F.struct("confidence", "kind")).alias("best")).select(
        "context", "best.kind", "best.confidence"
    )


def _text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, base, added, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    ``base`` are the spans (kind, start, end in code points) of, leftmost and not overlapping within a kind:
    email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, ip ``[0-9]+(\\.[0-9]+){3}`` with parts up to 255,
    card ``[0-9]([ -]?[0-9])+`` with 13 to 19 digits and a Luhn check, phone ``\\+[0-9][ ().0-9-]+[0-9]`` with 9 to
    15 digits; matches that fail their check are dropped.  ``added`` are tokens that patterns mark; they overlap
    no base span.  A null text is empty; rows that repeat are found each; other columns are ignored; an empty
    table gives no rows.
    """
    found = durable(located(docs))
    tokens = found.select("doc_id", "row", F.explode("tokens").alias("x")).select("doc_id", "row", "x.*")
    marked = tokens.drop("kind").join(patterns(found), "context")
    added = marked.groupBy("row", F.col("doc_id").alias("d")).agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("added")
    )
    spans = "array<struct<kind:string,start:int,end:int>>"
    joined = found.join(added, (found["row"] == added["row"]) & found["doc_id"].eqNullSafe(added["d"]), "left").select(
        "doc_id",
        F.transform("base", lambda b: F.struct(b["kind"], b["start"], b["end"])).cast(spans).alias("base"),
        F.coalesce(F.sort_array("added"), F.array().cast(spans)).alias("added"),
    )
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    every = F.transform(
        F.sort_array(F.transform(
            F.concat("base", "added"), lambda s: F.struct(order[s["kind"]].alias("o"), s["start"], s["end"], s["kind"])
        )),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return joined.select(
        "doc_id", "base", "added", *[_count(kind).alias(f"n_{kind}") for kind in KINDS], F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(every).alias("spans"),
    )
