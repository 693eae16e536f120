"""Secret scans: known forms, and a battery of randomness tests for other tokens; DataFrame operations only.

A token of one of five encodings is put through three tests of the hypothesis that its symbols are random: chi-squared uniformity over cells of
the alphabet that ordinary words fill unevenly, the number of runs above and below the middle of the alphabet, and the lag-1 serial
correlation of the values. Three times the least p-value, ``s``, stands for the token: it is uniform for random tokens and minute for
words, paths and identifiers, the more so the longer they are.

A secret is reported where ordinary tokens hardly look so random. How they look is fitted per class of encoding and length on identifiers
that are glued together from common words and numbers: the root of ``-ln s`` is about normal there. So each token has a p-value of being
ordinary, and the Benjamini-Hochberg rule over all tokens of the input that no known form covers keeps the expected share of ordinary ones among the reported
below ``q``.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import materialize

#: Known forms, in the order in which spans of one start are listed: pattern, least length, the group it holds for.
#: A possessive or look-behind form matches exactly the maximal runs of the plain one, in linear time. Quotes are written as code points.
FORMS = {
    "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)""", 12, r"""(?s)^.*?[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)$"""),
    "access": (r"AKIA[A-Z0-9]++", 18, None),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{16,}+", 16, None),
}
KINDS = [*FORMS, "random"]
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
#: Vowels, common consonants and the other letters; digits (fixed values).
_V, _C, _R, _D = "aeiou", "tnshrdl", "bcfgjkmpqvwxyz", "0123456789"
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest: the form of a token, its alphabet in order of value, and the cells of the chi-squared test (an odd number).
ENCODINGS = {
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", _D + "abcdef", ("012", "345", "678", "9ab", "cdef")),
    "base32": ("^[A-Z2-7]+=*$", _UPPER + "234567", (_V.upper(), _C.upper(), _R.upper(), "234", "567")),
    "base36": ("^(?:[a-z0-9]+|[A-Z0-9]+)$", _LOWER + _D, (_V, _C, _R, _D[:5], _D[5:])),
    "base62": ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _D, (_V, _C, _R, (_V + _C).upper(), _R.upper(), _D[:5], _D[5:])),
    "base64": ("", _UPPER + _LOWER + _D + "+/", (_V, _C, _R, (_V + _C).upper(), _R.upper(), _D, "+/")),
}
#: Encodings without case.
_FOLDED = ("hex", "base36")
#: Upper ends of the classes of length.
LENGTHS = [24, 32, 40, 48, 64, 96, 128, 256]
#: Bins of -ln(s), four to one, the last open.
BINS = 240
#: Coefficients of the rational approximation 7.1.26 of erfc in Abramowitz and Stegun (fixed values).
_ERFC = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
#: What ordinary identifiers are glued from (fixed values): common words of four languages and of programs, and words of hexadecimal letters.
COMMON = """the of and to in is for on with this that from have which time people year make know take good some could them other than then look only come over think also back after work
first well even want because these give most data file name user index value count total result config server client model train test report image version update system public private static string
number object method class module package library default option request response session message content address account service product customer order der die und das nicht ein sich mit auf eine
werden haben wird sind noch nach bei nur les des une dans pour que qui pas avec sur plus par tout fait comme mais sont los las del una por con para como pero todo esta entre cuando muy sin sobre tiene""".split()
HEXISH = "ace add bad bed bee cab cafe dad dead decade deed ebb face facade fade fed feed beef added".split()
#: Numbers of words of an ordinary identifier.
_WORDS = (4, 5, 5, 6, 7, 8, 10, 12, 15, 20, 30, 55, 80)
#: Positions are laid out in blocks of so many matches.
_BLOCK = 64


# Expressions are written as SQL text: the lambdas below nest deeply, and Spark parses them faster than they are built call by call.
_names = itertools.count()


def _let(value: str, body: Callable[[str], str]) -> str:
    """The body with a value that is computed once."""
    name = f"v{next(_names)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def _fn(body: Callable[..., str], n: int = 1) -> str:
    """A lambda of ``n`` fresh variables."""
    names = [f"v{next(_names)}" for _ in range(n)]
    return f"{names[0] if n == 1 else '(' + ', '.join(names) + ')'} -> {body(*names)}"


def erfc(x: str) -> str:
    """For x >= 0."""

    def of(x: str) -> str:
        poly = "0D"
        for a in reversed(_ERFC):
            poly = f"({poly} + {a}D) / (1 + 0.3275911D * {x})"
        return f"({poly}) * exp(-{x} * {x})"

    return _let(x, of)


def scanned(items: str, zero: str, step: Callable[[str, str], str], out: Callable[[str, str], str], out_type: str) -> str:
    """``out(carry, item)`` for each item, where ``step(carry, item)`` gives the carry, an int, of the next.

    Arrays cannot grow in place, so the carries are first found for blocks of items, and then inside each block: work grows about linearly.
    """

    def laid(blocks: str) -> str:
        carries = f"aggregate({blocks}, struct({zero} AS carry, CAST(array() AS array<int>) AS all), {_fn(lambda a, b: f'struct(aggregate({b}, {a}.carry, {_fn(step, 2)}) AS carry, concat({a}.all, array({a}.carry)) AS all)', 2)}, {_fn(lambda a: f'{a}.all')})"
        grown = _fn(lambda a, x: f"struct({step(f'{a}.carry', x)} AS carry, concat({a}.out, array({out(f'{a}.carry', x)})) AS out)", 2)
        inside = _fn(lambda b, c: f"aggregate({b}, struct({c} AS carry, CAST(array() AS array<{out_type}>) AS out), {grown}, {_fn(lambda a: f'{a}.out')})", 2)
        return f"flatten(zip_with({blocks}, {carries}, {inside}))"

    return _let(items, lambda v: _let(f"transform(sequence(0, greatest((size({v}) - 1) DIV {_BLOCK}, 0L)), {_fn(lambda k: f'slice({v}, CAST({k} * {_BLOCK} + 1 AS int), {_BLOCK})')})", laid))


def found(text: str, pattern: str) -> str:
    """All matches as ``array<struct<start, end, token>>`` in code points, null where there are none.

    The pieces between matches and the matches themselves, laid end to end, give the positions.
    """
    pieces = f"transform(split({text}, r'{pattern}', -1), {_fn(lambda t: f'char_length({t})')})"
    laid = _let(f"regexp_extract_all({text}, r'{pattern}', 0)", lambda m: f"zip_with(slice({pieces}, 1, size({m})), {m}, {_fn(lambda g, t: f'struct({g} AS gap, {t} AS token)', 2)})")
    after = lambda at, x: f"({at} + {x}.gap + char_length({x}.token))"
    spans = scanned(laid, "0", after, lambda at, x: f"struct({at} + {x}.gap AS start, {after(at, x)} AS end, {x}.token AS token)", "struct<start:int,end:int,token:string>")
    return f"CASE WHEN {text} RLIKE r'{pattern}' THEN {spans} END"


def base_spans(text: str) -> str:
    """Known forms as ``array<struct<start, kind, end>>``; ``kind`` is the place in KINDS."""

    def of_form(kind: int, pattern: str, least: int, group: str | None) -> str:
        size = lambda t: f"char_length(regexp_extract({t}, r'{group}', 1))" if group else f"char_length({t})"
        kept = f"filter({found(text, pattern)}, {_fn(lambda s: size(f'{s}.token') + f' >= {least}')})"
        return f"coalesce(transform({kept}, {_fn(lambda s: f'struct({s}.start AS start, {kind} AS kind, {s}.end AS end)')}), CAST(array() AS array<struct<start:int,kind:int,end:int>>))"

    return f"array_sort(concat({', '.join(of_form(k, *form) for k, form in enumerate(FORMS.values()))}))"


def encoding_of(token: str) -> str:
    """The narrowest encoding that holds the token; null for digits alone, which are numbers."""
    cases = " ".join(f"WHEN {token} RLIKE '{form}' THEN '{name}'" for name, (form, _, _) in ENCODINGS.items() if form)
    return f"CASE WHEN {token} RLIKE '^[0-9]+=*$' THEN CAST(NULL AS string) {cases} ELSE '{list(ENCODINGS)[-1]}' END"


def randomness(token: str, encoding: str) -> str:
    """``s`` of a token of at least two symbols of the encoding, both as SQL: three times the least p-value of the battery, at most 1."""
    of = lambda f: f"CASE {encoding} " + " ".join(f"WHEN '{k}' THEN {f(*v)}" for k, v in ENCODINGS.items()) + " END"
    folded = f"CASE WHEN {encoding} IN ({', '.join(repr(x) for x in _FOLDED)}) THEN lower({token}) ELSE {token} END"
    total = lambda v, f: f"aggregate({v}, 0D, {_fn(lambda a, x: f'{a} + {f(x)}', 2)})"

    def battery(t: str, alphabet: str, n: str) -> str:
        k = f"char_length({alphabet})"

        def chi(cells: str) -> str:
            share = lambda c: f"({n} * char_length({c}) / {k})"
            half = total(cells, lambda c: f"pow({n} - char_length(translate({t}, {c}, '')) - {share(c)}, 2D) / {share(c)} / 2")
            # An even number of degrees of freedom has a closed form.
            return _let(half, lambda h: f"exp(-{h}) * (1 + {h} + CASE WHEN size({cells}) > 5 THEN {h} * {h} / 2 ELSE 0D END)")

        def runs(sides: str) -> str:
            low = f"CAST(char_length(replace({sides}, 'h', '')) AS double)"
            turns = f"(2 * {n} - char_length(replace({sides}, 'lh', '')) - char_length(replace({sides}, 'hl', ''))) / 2"
            return _let(f"2 * {low} * ({n} - {low}) / {n} + 1", lambda m: _let(f"({m} - 1) * ({m} - 2) / ({n} - 1)", lambda w: f"CASE WHEN {w} > 0 THEN {erfc(f'abs({turns} + 1 - {m}) / sqrt(2 * {w})')} ELSE pow(2D, 1 - {n}) END"))

        def serial(v: str) -> str:
            def at(m: str) -> str:
                variance = total(v, lambda x: f"({x} - {m}) * ({x} - {m})")
                lagged = total(f"zip_with(slice({v}, 1, size({v}) - 1), slice({v}, 2, size({v})), {_fn(lambda x, y: f'({x} - {m}) * ({y} - {m})', 2)})", lambda x: x)
                return _let(variance, lambda w: f"CASE WHEN {w} > 0 THEN {erfc(f'abs(({lagged} / {w} + 1 / {n}) * sqrt({n})) / sqrt(2D)')} ELSE pow(2D, 1 - {n}) END")

            return _let(f"{total(v, lambda x: x)} / {n}", at)

        p_chi = _let(of(lambda _, __, cells: f"array({', '.join(repr(c) for c in cells)})"), chi)
        p_runs = _let(f"translate({t}, {alphabet}, concat(repeat('l', {k} DIV 2), repeat('h', {k} - {k} DIV 2)))", runs)
        p_serial = _let(f"transform(slice(split({t}, '(?!^)'), 1, char_length({t})), {_fn(lambda c: f'CAST(instr({alphabet}, {c}) - 1 AS double)')})", serial)
        return f"least(1D, 3 * least({p_chi}, {p_runs}, {p_serial}))"

    plain = f"regexp_replace(translate({folded}, '-_', '+/'), '=+$', '')"
    return _let(plain, lambda t: _let(of(lambda _, alphabet, __: f"'{alphabet}'"), lambda a: _let(f"CAST(char_length({t}) AS double)", lambda n: battery(t, a, n))))


def judged(token: str) -> str:
    """``struct<stratum, minus_log>`` of a token: class of encoding and length, and -ln(s); null for numbers."""
    size = f"char_length(regexp_replace({token}, '=+$', ''))"
    stratum = " + ".join(f"CASE WHEN {size} > {top} THEN 1 ELSE 0 END" for top in LENGTHS)
    place = lambda e: f"array_position(array({', '.join(repr(k) for k in ENCODINGS)}), {e}) - 1"
    return _let(encoding_of(token), lambda e: f"CASE WHEN {e} IS NOT NULL THEN struct(CAST(({place(e)}) * {len(LENGTHS) + 1} + {stratum} AS int) AS stratum, -ln(greatest({randomness(token, e)}, 1e-300D)) AS minus_log) END")


def ordinary_tokens(spark: SparkSession, tokens: int) -> DataFrame:
    """``(token)``: identifiers glued from common words and numbers by rule, in seven styles."""
    dice = lambda n, *seed: f"CAST(pmod(xxhash64(id, {', '.join(seed)}), {n}) AS int)"

    def part(i: str) -> str:
        def styled(word: str) -> str:
            big = f"CASE WHEN {dice(20, i, '7')} = 0 THEN substring(upper({word}), 1, 4) ELSE initcap({word}) END"
            return f"CASE WHEN style = 2 OR (style = 1 AND {dice(2, i, '8')} = 0) THEN {big} WHEN style = 3 THEN upper({word}) WHEN style = 5 AND {dice(5, i, '9')} < 2 THEN initcap({word}) ELSE {word} END"

        number = f"CAST(CASE {dice(4, i, '1')} WHEN 0 THEN {dice(10, i, '2')} WHEN 1 THEN {dice(31, i, '3')} + 1 WHEN 2 THEN {dice(200, i, '4')} + 1900 ELSE {dice(10_000, i, '5')} END AS string)"
        word = f"CASE WHEN style = 6 THEN get(hexish, {dice(len(HEXISH), i, '6')}) ELSE get(common, {dice(len(COMMON), i, '6')}) END"
        return f"CASE WHEN {dice(100, i, '11')} < CASE WHEN style = 6 THEN 60 WHEN {i} = 0 THEN 0 ELSE 10 END THEN {number} ELSE {_let(word, styled)} END"

    ids = spark.range(tokens).selectExpr("id", "id % 7 AS style", f"CAST(get(split('{' '.join(map(str, _WORDS))}', ' '), {dice(len(_WORDS), '0')}) AS int) AS words", f"split('{' '.join(COMMON)}', ' ') AS common", f"split('{' '.join(HEXISH)}', ' ') AS hexish")
    parts = ids.selectExpr("style", f"transform(sequence(0, words - 1), {_fn(part)}) AS parts")
    return parts.selectExpr("array_join(parts, CASE style WHEN 0 THEN '_' WHEN 1 THEN '-' WHEN 5 THEN '/' ELSE '' END) AS token").where("char_length(token) >= 20")


_fitted: dict[int, dict[int, tuple[float, float]]] = {}


def ordinary_fit(spark: SparkSession, tokens: int = 14_000) -> dict[int, tuple[float, float]]:
    """Per class of encoding and length the mean and deviation of the root of -ln(s) of ordinary tokens.

    A class with fewer than 30 of them takes the figures of the next shorter one, where ordinary tokens look more random. Nothing here
    depends on the input, so a fit is kept.
    """
    if tokens not in _fitted:
        rows = ordinary_tokens(spark, tokens).selectExpr(f"{judged('token')} AS j").where("j IS NOT NULL").groupBy("j.stratum").agg(F.count("*").alias("n"), F.expr("avg(sqrt(j.minus_log))").alias("mean"), F.expr("stddev(sqrt(j.minus_log))").alias("sd")).collect()
        seen, out = {r.stratum: r for r in rows if r.n >= 30}, {}
        for k in range(len(ENCODINGS) * (len(LENGTHS) + 1)):
            first = k - k % (len(LENGTHS) + 1)
            near = next((seen[j] for j in [*range(k, first - 1, -1), *range(k, first + len(LENGTHS) + 1)] if j in seen), None)
            if near:
                out[k] = near["mean"], max(near.sd, 0.3)
        _fitted[tokens] = out
    return _fitted[tokens]


def p_ordinary(minus_log: float, fit: tuple[float, float]) -> float:
    """How likely an ordinary token of the class looks at least so random."""
    return 0.5 * math.erfc((fit[0] - math.sqrt(minus_log)) / fit[1] / math.sqrt(2))


def spans_of(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``base_spans``, and ``tested``: the other tokens with their class and bin, as ``array<struct<start, end, stratum, bin>>``.

    A token that a known form touches is not tested. Whether one does is found from both sides: the furthest end of the forms up to it, and
    the first start of those after it.
    """
    text = f"coalesce(`{text_col}`, '')"
    item = "struct<start:int,end:int,stratum:int,bin:int>"

    def tested(s: str) -> str:
        return _let(judged(f"{s}.token"), lambda j: f"struct({s}.start AS start, {s}.end AS end, {j}.stratum AS stratum, CAST(least({BINS}, floor({j}.minus_log * 4)) AS int) AS bin)")

    def free(tokens: str, base: str) -> str:
        known = lambda x: f"{x}.stratum = -1"
        forms = f"transform({base}, {_fn(lambda b: f'struct({b}.start AS start, {b}.end AS end, -1 AS stratum, 0 AS bin)')})"
        # A token that is touched loses its class; the known forms keep theirs.
        marked = lambda x, ok: f"struct({x}.start AS start, {x}.end AS end, CASE WHEN {known(x)} OR {ok} THEN {x}.stratum ELSE -2 END AS stratum, {x}.bin AS bin)"
        left = scanned(f"array_sort(concat({forms}, {tokens}))", "0", lambda c, x: f"CASE WHEN {known(x)} THEN greatest({c}, {x}.end) ELSE {c} END", lambda c, x: marked(x, f"{c} <= {x}.start"), item)
        both = scanned(f"reverse({left})", "2147483647", lambda c, x: f"CASE WHEN {known(x)} THEN {x}.start ELSE {c} END", lambda c, x: marked(x, f"{c} >= {x}.end"), item)
        return f"filter(reverse({both}), {_fn(lambda x: f'{x}.stratum >= 0')})"

    tokens = f"filter(transform({found(text, TOKEN)}, {_fn(tested)}), {_fn(lambda c: f'{c}.stratum IS NOT NULL')})"
    rows = df.withColumn("base_spans", F.expr(base_spans(text)))
    clear = _let(tokens, lambda t: f"CASE WHEN size({t}) > 0 AND size(base_spans) > 0 THEN {free(t, 'base_spans')} ELSE {t} END")
    return rows.withColumn("tested", F.expr(f"coalesce(CASE WHEN {text} RLIKE r'{TOKEN}' THEN {clear} END, CAST(array() AS array<{item}>))"))


def random_upto(spark: SparkSession, counts: dict[tuple[int, int], int], q: float) -> dict[int, int]:
    """Per class the last bin whose tokens are reported, by Benjamini-Hochberg over all tokens; classes without one are left out."""
    fit = ordinary_fit(spark) if counts else {}
    ranked = sorted((p_ordinary((b + 1) / 4, fit[k]), k, b, n) for (k, b), n in counts.items() if k in fit)
    total, upto, limit = sum(counts.values()), 0, -1.0
    for p, _, _, n in ranked:
        upto += n
        if p <= q * upto / total:
            limit = p
    ends: dict[int, int] = {}
    for p, k, b, _ in ranked:
        if p <= limit:
            ends[k] = max(b, ends.get(k, -1))
    return ends


def limits_of(spans: DataFrame, q: float) -> dict[int, int]:
    """Counts all tested tokens by class and bin (a fixed number of counts reaches the driver) and decides."""
    rows = spans.select(F.explode("tested").alias("c")).groupBy("c.stratum", "c.bin").count().collect()
    return random_upto(spans.sparkSession, {(r.stratum, r.bin): r["count"] for r in rows}, q)


def with_random(df: DataFrame, ends: dict[int, int]) -> DataFrame:
    """Adds ``all_spans``: known forms and reported tokens."""
    limit = F.create_map(*[F.lit(x) for k, v in sorted(ends.items()) for x in (k, v)]) if ends else None
    random = lambda c: F.coalesce(c["bin"] <= limit[c["stratum"]], F.lit(False)) if limit is not None else F.lit(False)
    kept = F.transform(F.filter("tested", random), lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end")))
    return df.withColumn("all_spans", F.array_sort(F.concat("base_spans", kept)))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.05) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row.

    A null or empty text has no spans (and the digest of the empty string). Repeated rows are judged alike, row by row, and each counts. Extra
    columns are ignored. Positions are code points, ends exclusive. Texts are read once: their spans and tests are kept, without the text.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tested = materialize(spans_of(docs, "text").drop("text"))
    spans = with_random(tested, limits_of(tested, q))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return spans.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(FORMS)], F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"), listed(F.col("all_spans")).alias("spans"))


def masked(text: str, spans: str, mask: str, piece: int = 4096) -> Column:
    """The text with each run of overlapping spans replaced by the mask; the text is cut into pieces of so many code points.

    Each piece drops what its spans cover, and the mask stands where a run begins, so no text grows mark by mark.
    """
    runs = scanned(spans, "0", lambda c, s: f"greatest({c}, {s}.end)", lambda c, s: f"struct(greatest({s}.start, {c}) AS start, greatest({s}.end, {c}) AS end, {s}.start >= {c} AS fresh)", "struct<start:int,end:int,fresh:boolean>")
    shown = mask.replace("\\", "\\\\").replace("'", "\\'")

    def one(runs: str, k: str) -> str:
        lo = f"{k} * {piece}"
        here = f"filter({runs}, {_fn(lambda r: f'{r}.start < {lo} + {piece} AND {r}.end > {lo}')})"

        def cut(chunk: str) -> str:
            def step(a: str, r: str) -> str:
                begin, end = f"greatest({r}.start - {lo}, 0)", f"least({r}.end - {lo}, {piece})"
                sign = f"CASE WHEN {r}.fresh AND {r}.start >= {lo} THEN '{shown}' ELSE '' END"
                return f"struct(greatest({a}.at, {end}) AS at, concat({a}.out, substring({chunk}, {a}.at + 1, {begin} - {a}.at), {sign}) AS out)"

            return f"aggregate({here}, struct(0 AS at, '' AS out), {_fn(step, 2)}, {_fn(lambda a: f'concat({a}.out, substring({chunk}, {a}.at + 1, {piece}))')})"

        return _let(f"substring({text}, {lo} + 1, {piece})", cut)

    return F.expr(_let(runs, lambda r: f"array_join(transform(sequence(0, CAST(char_length({text}) DIV {piece} AS int)), {_fn(lambda k: one(r, k))}), '')"))


def redact(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]", q: float = 0.05) -> DataFrame:
    """``df`` with each secret in ``text_col`` replaced by ``mask``; other columns and texts without secrets stay as they are."""
    helper = ["base_spans", "tested", "all_spans"]
    names = {c: f"__own_{c}" for c in df.columns if c in helper}
    spans = spans_of(df.withColumnsRenamed(names), text_col)
    spans = with_random(spans, limits_of(spans, q))
    text = F.col(text_col)
    return spans.withColumn(text_col, F.when(F.size("all_spans") > 0, masked(f"`{text_col}`", "all_spans", mask)).otherwise(text)).drop(*helper).withColumnsRenamed({v: k for k, v in names.items()})
