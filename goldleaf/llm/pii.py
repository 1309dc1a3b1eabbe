"""Personal data: exact shapes first, then contexts learned from them.

Base spans are matches of fixed shapes (e-mail, IP address, card, phone) that pass a check. They are the
seeds of a bootstrap: the one and the two words before a seed are lexical patterns, identifier-like
tokens (with a digit or an at sign) that follow the same words are instances. A pattern's score for a
kind is the weight of that kind's instances among all its distinct instances, shrunk by `PRIOR`
instances that are none. Patterns above `CONFIDENT` with `SUPPORT` or more instances of the kind pass
their score on to their other instances, which weigh in the next round and count there towards the
support of every pattern they follow, so that patterns without a seed enter as well. After `ROUNDS` rounds
the tokens that follow confident patterns are spans too. Spans never remove others.

All of it is DataFrame expressions. Edges of the pattern-instance graph are made distinct and counted
before they meet; patterns with too few instances to ever have support are left out, and the patterns with the most
instances are joined by broadcast, so no task gets all instances of a frequent word. Long texts are handled in pieces, cut
where no match can be, so the time of a text is in proportion to its length, however many matches it holds.

Defined results: a null or empty text has no spans; spans are in code points, end exclusive; equal
starts are ordered by kind. Repeated rows get equal spans. An empty table gives an empty result.
Extra columns are carried along if asked for, otherwise ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.skew import join_counted
from goldleaf.session import written

KINDS = ("email", "ip", "card", "phone")
#: Shapes. Possessive quantifiers and look-behinds only spare attempts that cannot succeed: a
#: match begins where a run of its first characters does, or where the match before it ended.
SHAPES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Something that has to stand in a text for a shape to be looked for.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Digit groups divided by single blanks, dots, hyphens or brackets are one token; an IP address is not joined.
_IP = r"[0-9]++(?:\.[0-9]++){3}"
_GROUP = rf"(?:[)\]]?[ .-]?[(\[]?|[)\]] [(\[]?)(?<![0-9])(?!{_IP})[0-9]++(?![^\x20\x09-\x0D.,;:!?()\[\]\x22'-])"
TOKEN = (
    rf"(?<![^\x20\x09-\x0D])(?:[(\[]?(?!{_IP})[0-9]++(?:{_GROUP})++|[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]*+"
)
#: Texts beyond twice this are handled in pieces of at least so many code points.
PIECE = 2000
#: A piece ends behind a line feed, or behind a blank that a letter follows: no shape and no token reaches over either.
CUT = rf"(?s).{{{PIECE}}}.*?(?:\x0A|\x20(?=[A-Za-z])|\z)|.+"
#: Pieces whose spans are sorted out together.
TOGETHER = 64
#: Code points before a token in which its context is looked for.
CONTEXT = 80
ROUNDS = 3
SUPPORT = 8
PRIOR = 2
CONFIDENT = 0.8
#: Shortest token that can be an identifier.
LEAST = 5

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SPANS = "array<struct<start:int,rank:int,stop:int>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = backwards.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15)


def _located(text: Column, pattern: str) -> Column:
    """Matches of a pattern, each with the stretch of text before it that no match holds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    return F.arrays_zip(between.alias("b"), found.alias("m"))


def pieces(text: Column) -> Column:
    """Pieces of a text: `at`, where it begins, the `before` it, and its `text`."""

    def add(state: Column, part: Column) -> Column:
        piece = F.struct(state.at.alias("at"), state.before.alias("before"), part.alias("text"))
        return F.struct(
            (state.at + F.length(part)).alias("at"), F.right(part, F.lit(CONTEXT)).alias("before"),
            F.concat(state.out, F.array(piece)).alias("out"),
        )

    cut = F.when(F.length(text) > 2 * PIECE, F.regexp_extract_all(text, F.lit(CUT), F.lit(0))).otherwise(F.array(text))
    none = F.struct(
        F.lit(0).alias("at"), F.lit("").alias("before"), F.array().cast("array<struct<at:int,before:string,text:string>>").alias("out")
    )
    return F.aggregate(cut, none, add, lambda s: s.out)


def _spans(piece: Column, kind: str) -> Column:
    """Valid matches of one kind in a piece, by place in the text."""
    rank = KINDS.index(kind)

    def add(state: Column, x: Column) -> Column:
        start = state.at + F.length(x.b)
        stop = start + F.length(x.m)
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop")))
        keep = F.when(_valid(kind, x.m), F.concat(state.out, span)).otherwise(state.out)
        return F.struct(stop.alias("at"), keep.alias("out"))

    hint = HINTS[kind]
    likely = F.contains(piece.text, F.lit(hint)) if hint else piece.text.rlike("[0-9][ -]?[0-9]")
    none = F.struct(piece.at.alias("at"), F.array().cast(_SPANS).alias("out"))
    # The stretch behind the last match has none.
    pairs = F.filter(_located(piece.text, SHAPES[kind]), lambda x: x.m.isNotNull())
    return F.when(likely, F.aggregate(pairs, none, add, lambda s: s.out)).otherwise(F.array().cast(_SPANS))


def base_spans(piece: Column) -> Column:
    """Valid spans of every kind in a piece, in order."""
    return F.array_sort(F.concat(*[_spans(piece, kind) for kind in KINDS]))


def _patterns(before: Column) -> Column:
    """Patterns of a context: its last word, and its last two."""
    n = F.size(before)
    one = F.when(n > 0, F.element_at(before, -1))
    two = F.when(n > 1, F.concat_ws(" ", before))
    return F.filter(F.array(one, two), lambda p: p.isNotNull())


def _last_two(stretch: Column) -> Column:
    near = F.lower(F.right(stretch, F.lit(CONTEXT)))
    words = F.regexp_extract_all(near, F.lit(r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?"), F.lit(0))
    n = F.size(words)
    return F.when(n > 2, F.slice(words, -2, 2)).otherwise(words)


_TOKENS = "array<struct<start:int,stop:int,token:string,before:string>>"


def _tokens(piece: Column) -> Column:
    """Identifier-like tokens of a piece, with what stands before them."""

    def locate(state: Column, x: Column) -> Column:
        start = state.at + F.length(x.b)
        stop = start + F.length(x.m)
        # The end of the text before it, whatever tokens that holds.
        before = F.right(F.concat(state.tail, x.b), F.lit(CONTEXT))
        token = F.array(F.struct(start.alias("start"), stop.alias("stop"), F.lower(x.m).alias("token"), before.alias("before")))
        keep = F.when(F.length(x.m) >= LEAST, F.concat(state.out, token)).otherwise(state.out)
        return F.struct(stop.alias("at"), F.right(F.concat(before, x.m), F.lit(CONTEXT)).alias("tail"), keep.alias("out"))

    none = F.struct(piece.at.alias("at"), piece.before.alias("tail"), F.array().cast(_TOKENS).alias("out"))
    pairs = F.filter(_located(piece.text, TOKEN), lambda x: x.m.isNotNull())
    found = F.aggregate(pairs, none, locate, lambda s: s.out)
    return F.when(piece.text.rlike("[0-9@]"), found).otherwise(F.array().cast(_TOKENS))


def _seeds(piece: Column, spans: Column) -> Column:
    """Base spans of a piece as tokens."""

    def seed(span: Column) -> Column:
        first = span.start - piece.at
        return F.struct(
            span.start.alias("start"), span.stop.alias("stop"), span["rank"].alias("rank"),
            F.lower(piece.text.substr(first + 1, span.stop - span.start)).alias("token"),
            F.right(F.concat(piece.before, piece.text.substr(F.lit(1), first)), F.lit(CONTEXT)).alias("before"),
        )

    return F.transform(spans, seed)


def with_base(docs: DataFrame, carry: dict[str, str], text: str) -> DataFrame:
    """Carried columns, a row number, base spans, and the identifier-like tokens with their contexts."""
    plain = docs.select(
        *[F.col(c).alias(n) for c, n in carry.items()], pieces(F.coalesce(F.col(text), F.lit(""))).alias("_p")
    )
    found = plain.select(*carry.values(), F.transform("_p", lambda p: F.struct(p.alias("p"), base_spans(p).alias("spans"), _tokens(p).alias("tokens"))).alias("_f"))

    def outside(x: Column) -> Column:
        return F.filter(x.tokens, lambda t: ~F.exists(x.spans, lambda s: (s.start < t.stop) & (s.stop > t.start)))

    return found.select(
        *carry.values(), F.monotonically_increasing_id().alias("_row"),
        F.flatten(F.transform("_f", lambda x: x.spans)).alias("_base"),
        F.flatten(F.transform("_f", lambda x: _seeds(x.p, x.spans))).alias("_seeds"),
        F.flatten(F.transform("_f", outside)).alias("_tokens"),
    )


def contexts(found: DataFrame) -> DataFrame:
    """A row per seed or token and pattern before it: _row, start, stop, rank (of a seed), token, pattern."""
    seeds = found.select("_row", F.explode("_seeds").alias("x"))
    tokens = found.select("_row", F.explode("_tokens").alias("x"))
    rows = seeds.select("_row", "x.start", "x.stop", "x.rank", "x.token", "x.before").union(
        tokens.select("_row", "x.start", "x.stop", F.lit(None).cast("int"), "x.token", "x.before")
    )
    return rows.select("_row", "start", "stop", "rank", "token", F.explode(_patterns(_last_two(F.col("before")))).alias("pattern"))


def confident_patterns(seen: DataFrame) -> DataFrame:
    """pattern, rank (of the kind it announces) and score, after ROUNDS rounds over the graph."""
    # Distinct edges; an instance that is a seed of several kinds anywhere counts for its first.
    edges = written(seen.groupBy("pattern", "token").agg(F.min("rank").alias("rank")), "edges")
    # A pattern with fewer instances than SUPPORT cannot have support in any round.
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("every")).where(F.col("every") >= SUPPORT)
    sizes = written(sizes, "pattern-sizes")
    graph = written(join_counted(edges, sizes, "pattern", "every"), "patterns")
    seeds = graph.where(F.col("rank").isNotNull())
    # Per pattern and kind: its instances of the kind, and what they weigh.
    known = written(
        seeds.groupBy("pattern", F.col("rank").alias("kind"), "every").agg(F.count("*").alias("held"), F.count("*").cast("double").alias("weight")),
        "pattern-seeds",
    )
    open_edges = graph.where(F.col("rank").isNull()).select("pattern", "token")

    def scored(held: DataFrame) -> DataFrame:
        score = F.col("weight") / (F.col("every") + PRIOR)
        return held.where(F.col("held") >= SUPPORT).select("pattern", "kind", "every", score.alias("score"))

    scores = scored(known)
    for _ in range(ROUNDS - 1):
        sure = scores.where(F.col("score") >= CONFIDENT)
        # What confident patterns say of tokens that are no seeds: chance that not all of them are wrong.
        said = join_counted(open_edges, sure, "pattern", "every").groupBy("token", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("weight")
        )
        # Only confident patterns' tokens are known to be of a kind; those may follow any pattern.
        gained = open_edges.join(said, "token").groupBy("pattern", "kind").agg(
            F.count("*").alias("held"), F.sum("weight").alias("weight")
        ).join(sizes, "pattern")
        both = known.unionByName(gained).groupBy("pattern", "kind", "every").agg(
            F.sum("held").alias("held"), F.sum("weight").alias("weight")
        )
        scores = written(scored(both), "pattern-scores")
    best = scores.where(F.col("score") >= CONFIDENT).groupBy("pattern").agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
    return best.select("pattern", (-F.col("b.col2")).alias("kind"), F.col("b.score").alias("score"))


def spotted(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """Carried columns, `base` and `spans` (start, rank of the kind, stop) of every document."""
    named = {c: f"_c{i}" for i, c in enumerate(carry)}
    found = written(with_base(docs, named, text), "spans")
    seen = written(contexts(found), "contexts")
    sure = confident_patterns(seen)
    # How many rows each of the confident patterns has, as that can be any share of them all.
    open_rows = seen.where(F.col("rank").isNull())
    sure = written(open_rows.groupBy("pattern").agg(F.count("*").alias("rows")).join(sure, "pattern"), "confident")
    # A token that several confident patterns announce is of the best one's kind.
    new = (
        join_counted(open_rows, sure, "pattern", "rows")
        .groupBy("_row", "start", "stop")
        .agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
        .groupBy("_row")
        .agg(F.collect_list(F.struct("start", (-F.col("b.col2")).alias("rank"), "stop")).alias("_new"))
        .withColumnRenamed("_row", "_r")
    )
    every = F.array_sort(F.concat("_base", F.coalesce(F.col("_new"), F.array().cast(_SPANS))))
    return found.join(new, F.col("_row") == F.col("_r"), "left").select(
        *[F.col(n).alias(c) for c, n in named.items()], F.col("_base").alias("base"), every.alias("spans")
    )


def written_out(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s.start.cast("string"), s.stop.cast("string"))), ","
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def _masked_piece(piece: Column, spans: Column) -> Column:
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def add(state: Column, s: Column) -> Column:
        ahead = F.when(
            s.start >= state.at,
            F.concat(
                state.out,
                F.array(piece.text.substr(state.at - piece.at + 1, s.start - state.at), F.element_at(tags, s["rank"] + 1)),
            ),
        ).otherwise(state.out)
        return F.struct(F.greatest(state.at, s.stop).alias("at"), ahead.alias("out"))

    none = F.struct(piece.at.alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: piece.text.substr(s.at - piece.at + 1, F.length(piece.text))
    done = F.aggregate(spans, none, add, lambda s: F.concat(F.array_join(s.out, ""), rest(s)))
    return F.when(F.size(spans) > 0, done).otherwise(piece.text)


def _begins_in(spans: Column, some: Column) -> Column:
    """The spans that begin in one of some neighbouring pieces."""
    last = F.element_at(some, -1)
    return F.filter(spans, lambda s: (s.start >= some[0].at) & (s.start < last.at + F.length(last.text)))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first's.

    Spans are sorted out to TOGETHER pieces first, then to single ones; none reaches over a piece.
    """
    parts = pieces(text)
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / TOGETHER).cast("int")),
        lambda g: F.slice(parts, g * TOGETHER + 1, F.lit(TOGETHER)),
    )
    coarse = F.transform(groups, lambda some: F.struct(some.alias("some"), _begins_in(spans, some).alias("own")))
    fine = F.flatten(
        F.transform(coarse, lambda c: F.transform(c.some, lambda p: F.struct(p.alias("p"), _begins_in(c.own, F.array(p)).alias("own"))))
    )
    done = F.array_join(F.transform(fine, lambda x: _masked_piece(x.p, x.own)), "")
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with all their columns, personal data in the text masked."""
    packed = docs.select(F.struct(*docs.columns).alias("_whole"), F.col(text).alias("_t"))
    found = spotted(packed, ["_whole"], "_t")
    return found.select("_whole.*", masked(F.col("_whole")[text], F.col("spans")).alias("_masked")).select(
        *[F.col("_masked").alias(c) if c == text else F.col(c) for c in docs.columns]
    )
