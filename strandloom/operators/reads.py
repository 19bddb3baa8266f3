"""Operators on sequences and short reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as sq


def pieces(seqs: DataFrame, before: int = 0, after: int = 0, size: int = 128) -> DataFrame:
    """seq_id, offset, lead, body, piece: sequences in bodies of ``size`` letters, with letters from both neighbours around.

    offset: letters before the body; lead: how many letters of the piece come before it. Picking letters by place walks
    from a string's start, so whole contigs must not be searched that way: work on pieces is linear in the contig.
    """
    chunks = F.regexp_extract_all("sequence", F.lit(f"(?s).{{1,{size}}}"), 0)
    rows = seqs.select("seq_id", chunks.alias("_c")).select(
        "seq_id",
        F.explode(
            F.transform(
                "_c",
                lambda c, i: F.struct(
                    (i.cast("long") * size).alias("offset"),
                    F.coalesce(F.right(F.get("_c", i - 1), F.lit(before)), F.lit("")).alias("left"),
                    c.alias("body"),
                    F.coalesce(F.left(F.get("_c", i + 1), F.lit(after)), F.lit("")).alias("right"),
                ),
            )
        ).alias("x"),
    )
    return rows.select("seq_id", "x.offset", F.length("x.left").alias("lead"), F.length("x.body").alias("body"), F.concat("x.left", "x.body", "x.right").alias("piece"))


def tiled(seqs: DataFrame, step: int, width: int) -> DataFrame:
    """seq_id, k (from 0), start, sequence: width letters (fewer at the end) from every step-th place of whole sequences."""
    size = step * -(-max(128, width) // step)
    rows = pieces(seqs, 0, width - 1, size).select("seq_id", "offset", "piece", F.explode(F.expr(f"sequence(0, (body - 1) div {step})")).alias("j"))
    return rows.select("seq_id", (F.expr(f"offset div {step}") + F.col("j")).alias("k"), (F.col("offset") + F.col("j") * step + 1).alias("start"), F.expr(f"substring(piece, cast(j * {step} + 1 as int), {width})").alias("sequence"))


def _words(k: int) -> Column:
    """All words of k letters that start in a piece's body."""
    return F.expr(f"transform(sequence(1, greatest(least(body, length(piece) - {k - 1}), 1)), i -> substring(piece, i, {k}))")


def _pieces_of_words(seqs: DataFrame, k: int) -> DataFrame:
    # small pieces, as a word is found by walking from its piece's start
    return pieces(seqs, 0, k - 1, size=32).where(F.length("piece") >= k)


def kmers(seqs: DataFrame, k: int) -> DataFrame:
    """Counts of all words of k letters (word, n), with partial counts before the shuffle."""
    return _pieces_of_words(seqs, k).select(F.explode(_words(k)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def observed_expected(seqs: DataFrame, k: int) -> DataFrame:
    """Word, n, and its frequency over the product of its letters' frequencies; single letters are four rows or so."""
    one, many = kmers(seqs, 1), kmers(seqs, k)
    all_one, all_many = one.agg(F.sum("n").alias("s1")), many.agg(F.sum("n").alias("sk"))
    share = F.broadcast(one.join(F.broadcast(all_one)).agg(F.map_from_entries(F.collect_list(F.struct("word", F.col("n") / F.col("s1")))).alias("share")))
    expected = F.aggregate(F.split("word", ""), F.lit(1.0), lambda p, x: p * F.coalesce(F.element_at(F.col("share"), x), F.lit(1.0)))
    out = many.join(F.broadcast(all_many)).join(share)
    return out.select("word", "n", (F.col("n") / F.col("sk") / expected).alias("ratio"))


def adapters(reads: DataFrame, k: int, top: int) -> DataFrame:
    """The most frequent words of k letters: in all, and in how many reads."""
    each = _pieces_of_words(reads, k).select("seq_id", F.explode(_words(k)).alias("word")).groupBy("seq_id", "word").agg(F.count("*").alias("n"))
    return each.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("reads")).orderBy(F.desc("reads"), F.desc("n"), "word").limit(top)


def cytosines(seqs: DataFrame) -> DataFrame:
    """M5, M6: seq_id, pos, strand, context of every C of both strands."""
    # places are picked from arrays of a piece's letters, and only C and G become rows
    rows = pieces(seqs, 2, 2).select("seq_id", "offset", "lead", "body", F.split("piece", "").alias("_l"))
    at = F.filter(F.expr("sequence(lead + 1, lead + body)"), lambda i: F.get("_l", i - 1).isin("C", "G"))

    def site(i: Column) -> Column:
        base, forward = F.get("_l", i - 1), F.slice("_l", i, F.lit(3))
        back = F.slice("_l", F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3)))
        return F.struct(i.alias("i"), base.alias("base"), F.array_join(F.when(base == "C", forward).otherwise(back), "").alias("tri"))

    rows = rows.select("seq_id", "offset", "lead", F.explode(F.transform(at, site)).alias("x"))
    base, tri = F.col("x.base"), F.when(F.col("x.base") == "C", F.col("x.tri")).otherwise(sq.reverse_complement(F.col("x.tri")))
    pos = (F.col("offset") + F.col("x.i") - F.col("lead")).cast("int")
    return rows.select("seq_id", pos.alias("pos"), F.when(base == "C", "+").otherwise("-").alias("strand"), sq.context(tri).alias("context"), tri.alias("triplet"))


def call_methylation(reads: DataFrame, bases: DataFrame, conversion: str = "c2t", many: int = 20) -> DataFrame:
    """M1: seq_id, pos, c, t, context, starred: counts of kept and converted bases at each C (c2t) or G (g2a).

    reads: seq_id, start, sequence on the forward strand; bases: seq_id, sequence. Reads are cut in letters and counted
    (partial sums first) and meet the genome's sites once; sites without a count are left out. starred: c + t > many.
    """
    kept, converted = {"c2t": ("C", "T"), "g2a": ("G", "A")}[conversion]
    each = F.transform(F.split("sequence", ""), lambda x, i: F.struct(i.alias("i"), x.alias("letter")))
    letters = reads.select("seq_id", "start", F.explode(F.filter(each, lambda x: x["letter"].isin(kept, converted))).alias("x")).select("seq_id", (F.col("start") + F.col("x.i")).alias("pos"), "x.letter")
    counts = letters.groupBy("seq_id", "pos").agg(F.count_if(F.col("letter") == kept).alias("c"), F.count_if(F.col("letter") == converted).alias("t"))
    sites = cytosines(bases).where(F.col("strand") == ("+" if conversion == "c2t" else "-"))
    return counts.join(sites, ["seq_id", "pos"]).where("c + t > 0").withColumn("starred", F.col("c") + F.col("t") > many)


def call_methylation_of_pairs(reads: DataFrame, bases: DataFrame) -> DataFrame:
    """M3: seq_id, pos, strand, c, t: /1 reads count at C (c, or t for T), /2 reads at G (c for G, t for A).

    reads: pair_id, mate (1 or 2), seq_id, start, sequence. Positions that both mates of a pair cover count for mate 1 only.
    """
    letters = reads.select("pair_id", "mate", "seq_id", F.posexplode(F.split("sequence", "")).alias("i", "letter"), "start").where("letter <> ''")
    once = letters.groupBy("pair_id", "seq_id", (F.col("start") + F.col("i")).alias("pos")).agg(F.min(F.struct("mate", "letter")).alias("x"))
    first = F.col("x.mate") == 1
    kept, converted = F.when(first, "C").otherwise("G"), F.when(first, "T").otherwise("A")
    counts = once.groupBy("seq_id", "pos", F.when(first, "+").otherwise("-").alias("strand")).agg(F.count_if(F.col("x.letter") == kept).alias("c"), F.count_if(F.col("x.letter") == converted).alias("t"))
    return counts.join(cytosines(bases).select("seq_id", "pos", "strand"), ["seq_id", "pos", "strand"]).where("c + t > 0")


def frequencies(called: DataFrame) -> DataFrame:
    """M2: by context sums of unflagged and of all rows and the share of c."""
    ok = ~F.col("starred")
    cells = [F.sum(F.when(ok, F.col(x)).otherwise(0)).alias(f"unflagged_{x}") for x in ("c", "t")] + [F.sum(x).alias(x) for x in ("c", "t")]
    return called.groupBy("context").agg(*cells, F.count("*").alias("sites")).withColumn("share", F.round(F.try_divide(F.col("c"), F.col("c") + F.col("t")), 6))


def competition(a: DataFrame, b: DataFrame) -> DataFrame:
    """read_id, winner: a or b by fewer mismatches, by being the only one, or tie."""
    both = a.select("read_id", F.col("mismatches").alias("_a")).join(b.select("read_id", F.col("mismatches").alias("_b")), "read_id", "full")
    x, y = F.col("_a"), F.col("_b")
    winner = F.when(y.isNull() | (x < y), "a").when(x.isNull() | (y < x), "b").otherwise("tie")
    return both.select("read_id", winner.alias("winner"))


def sam_competition(a: DataFrame, b: DataFrame) -> DataFrame:
    """The same by mismatches, then by mapping quality, then equal if the sets of differences are."""
    cells = ("mismatches", "mapq", "snps")
    both = a.select("read_id", *(F.col(c).alias(f"a_{c}") for c in cells)).join(b.select("read_id", *(F.col(c).alias(f"b_{c}") for c in cells)), "read_id")
    less, more = F.col("a_mismatches") - F.col("b_mismatches"), F.col("a_mapq") - F.col("b_mapq")
    same = F.array_sort("a_snps") == F.array_sort("b_snps")
    winner = F.when(less < 0, "a").when(less > 0, "b").when(more > 0, "a").when(more < 0, "b").when(same, "same").otherwise("differ")
    return both.select("read_id", winner.alias("winner"))


def _picked(n: Column, seed: int, end: int) -> Column:
    """A number below n, the same for each run with the seed, by a digest of the read's id and end."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{end}:"), F.col("read_id").cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.greatest(n, F.lit(1))).cast("int")


def paired(left: DataFrame, right: DataFrame, offset: int = 0, distance: int = 300, seed: int = 0, at_random: bool = False, trust_second: bool = False, single_ends: bool = False) -> DataFrame:
    """Both ends of every pair: read_id, mate, class, seqid, start, end, strand, mismatches, score.

    left and right: read_id, size (of the read), matches (array of seqid, length of that sequence, reverse, position on its
    own strand, mismatches). class: the matches of /1 and /2, each NM, U or R, with * at an end that was placed at random.
    Ends fit if they lie on opposite strands of a sequence (single_ends: on the same one) and, mirrored, at most offset +
    distance apart; with several matches the nearest pair counts, the first of equal ones, and must be offset apart at
    least. Ends that fit are both placed. Else a unique /1 read is trusted, a unique /2 read only without a match of /1 and
    with trust_second, and an end with several matches gets one at random if at_random (/2: and trust_second). An end that
    is not placed has nulls and score 0, or the number of its matches where it has several and its mate has none.
    """
    cells = ("size", "matches")
    both = left.select("read_id", *(F.col(c).alias(f"l_{c}") for c in cells)).join(right.select("read_id", *(F.col(c).alias(f"r_{c}") for c in cells)), "read_id", "full")
    none = F.filter(F.coalesce("l_matches", "r_matches"), lambda x: F.lit(False))
    both = both.withColumns({"l": F.coalesce("l_matches", none), "r": F.coalesce("r_matches", none)})
    n, m = F.size("l"), F.size("r")

    def gap(x: Column, y: Column) -> Column:
        if single_ends:
            return F.when((x["seqid"] == y["seqid"]) & (x["reverse"] == y["reverse"]), F.abs(x["position"] - y["position"]) - F.col("l_size"))
        return F.when((x["seqid"] == y["seqid"]) & (x["reverse"] != y["reverse"]), F.abs(x["length"] - x["position"] + 1 - y["position"]))

    pairs = F.flatten(F.transform("l", lambda x, i: F.transform("r", lambda y, j: F.struct(gap(x, y).alias("gap"), i.alias("i"), j.alias("j")))))
    best = F.array_min(F.filter(pairs, lambda p: p["gap"] <= offset + distance))
    both = both.withColumn("best", best).withColumn("fit", F.coalesce((F.col("best.gap") >= offset) | ((n == 1) & (m == 1) & F.col("best").isNotNull()), F.lit(False)))
    fit, lost = F.col("fit"), F.lit(None).cast("int")
    random_l, random_r = F.lit(at_random) & (n > 1) & ~fit, F.lit(at_random and trust_second) & (((m > 1) & ~fit) | ((n > 1) & (m == 1) & ~fit))
    at_l = F.when(n == 0, lost).when(fit, F.col("best.i")).when(n == 1, 0).when(random_l, _picked(n, seed, 1))
    at_r = F.when(m == 0, lost).when(fit, F.col("best.j")).when((n == 0) & (m == 1) & F.lit(trust_second), 0).when(random_r, _picked(m, seed, 2))
    kind = lambda c: F.when(c == 0, "NM").when(c == 1, "U").otherwise("R")
    name = F.concat(kind(n), F.lit("/"), kind(m))
    star = lambda c: F.when(c, "*").otherwise("")
    ends = F.array(
        F.struct(F.lit(1).alias("mate"), F.concat(name, star(random_l)).alias("class"), F.get("l", at_l).alias("x"), F.col("l_size").alias("size"), F.when((n > 1) & (m == 0), n).otherwise(0).alias("several")),
        F.struct(F.lit(2).alias("mate"), F.concat(name, star(random_r)).alias("class"), F.get("r", at_r).alias("x"), F.col("r_size").alias("size"), F.when((m > 1) & (n == 0), m).otherwise(0).alias("several")),
    )
    x = F.col("e.x")
    placed = both.select("read_id", F.explode(ends).alias("e"))
    score = F.when(x.isNotNull(), 1).otherwise(F.col("e.several"))
    strand = F.when(x["reverse"], "-").when(~x["reverse"], "+")
    return placed.select(
        "read_id", "e.mate", "e.class", x["seqid"].alias("seqid"), x["position"].alias("start"), (x["position"] + F.col("e.size") - 1).alias("end"), strand.alias("strand"), x["mismatches"].alias("mismatches"), score.alias("score")
    )


def targets(placed: DataFrame, seqs: DataFrame, around: int = 2) -> DataFrame:
    """read_id, mate and target of placed ends: the reference's bases there in their direction, with some on each side."""
    rows = placed.where("seqid is not null").join(seqs.select(F.col("seq_id").alias("seqid"), F.length("sequence").alias("_n")), "seqid")
    back = F.col("strand") == "-"
    low, high = F.when(back, F.col("_n") - F.col("end") + 1).otherwise(F.col("start")), F.when(back, F.col("_n") - F.col("start") + 1).otherwise(F.col("end"))
    features = rows.select(F.struct("read_id", "mate").alias("id"), F.col("seqid").alias("seq_id"), low.alias("start"), high.alias("end"), "strand")
    return extracted(seqs, features, around).select("id.read_id", "id.mate", F.col("bases").alias("target"))


def resolved(hits: DataFrame, most: int, seed: int = 0, at_random: bool = True) -> DataFrame:
    """read_id, kind (U, R or NM) and the position kept: the only one, one of up to ``most`` by a hash of seed, or none."""
    n = F.size("matches")
    pick = F.pmod(F.xxhash64(F.lit(seed), "read_id"), F.greatest(n, F.lit(1))).cast("int")
    at = F.when(n == 1, F.get("matches", F.lit(0))).when((n > 1) & (n <= most) & F.lit(at_random), F.get("matches", pick))
    kind = F.when(n == 1, "U").when(n > 1, "R").otherwise("NM")
    return hits.select("read_id", kind.alias("kind"), at["seqid"].alias("seqid"), at["position"].alias("position"))


def simulated_reads(ids: DataFrame, lengths: DataFrame, read_length: int, rate: float, seed: int = 0) -> DataFrame:
    """M9: read_id, sequence, start, end and converted for each id (by digest, so a repeated task makes the same reads)."""
    name = lambda salt: F.concat(F.lit(f"{seed}:{salt}:"), F.col("id").cast("string")).cast("binary")
    h = lambda salt: F.conv(F.substring(F.md5(name(salt)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    seqs = lengths.select(F.array_sort(F.collect_list(F.struct("sequence", "length"))).alias("s"))  # one row of a small table
    rows = ids.select("id").join(F.broadcast(seqs)).withColumn("x", F.get("s", F.floor(h(1) * F.size("s")).cast("int")))
    start = F.floor(h(2) * (F.col("x.length") - read_length + 1)).cast("int") + 1
    return rows.select(F.col("id").alias("read_id"), F.col("x.sequence").alias("sequence"), start.alias("start"), (start + read_length - 1).alias("end"), (h(3) < rate).alias("converted"))


PIECE = 128


def _whole(seqs: DataFrame, parts: DataFrame) -> DataFrame:
    """seqs with the sequences that parts (seq_id, offset, piece) make, in order."""
    made = parts.groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("_p"))
    made = made.select(F.col("seq_id").alias("_id"), F.array_join(F.transform("_p", lambda x: x["piece"]), "").alias("_s"))
    out = seqs.join(made, seqs["seq_id"] == F.col("_id"), "left")
    return out.withColumn("sequence", F.coalesce("_s", "sequence")).drop("_id", "_s")


def patched(seqs: DataFrame, snps: DataFrame) -> DataFrame:
    """Sequences with single bases replaced by a table of (seq_id, pos, alt); positions outside are ignored.

    Changes meet the piece that they are in, so a letter is looked up among the changes of its piece. Of several changes of
    a place the smallest letter counts.
    """
    one = snps.groupBy("seq_id", F.col("pos").cast("long").alias("pos")).agg(F.min("alt").alias("alt"))
    offset = F.expr(f"((pos - 1) div {PIECE}) * {PIECE}")
    changes = one.where("pos > 0").select(F.col("seq_id").alias("_id"), offset.alias("_at"), F.struct((F.col("pos") - offset).cast("int").alias("i"), "alt").alias("c"))
    changes = changes.groupBy("_id", "_at").agg(F.map_from_entries(F.collect_list("c")).alias("_m"))
    parts = pieces(seqs, size=PIECE)
    parts = parts.join(changes, (parts["seq_id"] == F.col("_id")) & (parts["offset"] == F.col("_at")), "left")
    letters = F.transform(F.split("piece", ""), lambda x, i: F.coalesce(F.element_at(F.col("_m"), i + 1), x))
    return _whole(seqs, parts.select("seq_id", "offset", F.when(F.col("_m").isNull(), F.col("piece")).otherwise(F.array_join(letters, "")).alias("piece")))


def genome_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """seq_id, pos, ref, alt where two sequences of the same id differ within their common length."""
    both = pieces(a, size=PIECE).select("seq_id", "offset", F.col("piece").alias("x")).join(pieces(b, size=PIECE).select("seq_id", "offset", F.col("piece").alias("y")), ["seq_id", "offset"]).where("x <> y")
    cells = F.zip_with(F.split("x", ""), F.split("y", ""), lambda p, q: F.struct(p.alias("ref"), q.alias("alt")))
    rows = both.select("seq_id", "offset", F.posexplode(cells).alias("i", "c"))
    return rows.where("c.ref <> c.alt").select("seq_id", (F.col("offset") + F.col("i") + 1).cast("int").alias("pos"), "c.ref", "c.alt")


def assembled(parts: DataFrame, seqs: DataFrame, gap: int = 0) -> DataFrame:
    """Scaffolds (object, sequence): parts' sequences in order, reversed and complemented on -, with N between them."""
    rows = extracted(seqs, parts.withColumn("id", F.struct("object", "part"))).select("id.object", F.struct(F.col("id.part"), F.col("bases")).alias("x"))
    ordered = rows.groupBy("object").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return ordered.select("object", F.array_join(F.transform("x", lambda x: x["bases"]), "N" * gap).alias("sequence"))


def extracted(seqs: DataFrame, features: DataFrame, flank: int = 0) -> DataFrame:
    """Each feature's bases (id, bases), with flanks, in its own direction; cut to the sequence, which must be known.

    A feature meets the pieces that it touches, so no row holds more of a sequence than a feature's own bases.
    """
    low, high = F.greatest(F.lit(1), F.col("start") - flank).cast("long"), (F.col("end") + flank).cast("long")
    rows = features.join(seqs.select("seq_id", F.length("sequence").alias("_n")), "seq_id")
    rows = rows.select("id", "seq_id", low.alias("_low"), F.least(high, F.col("_n")).alias("_high"), (F.col("strand") == "-").alias("_back"), F.monotonically_increasing_id().alias("_f"))
    at = F.when(F.col("_low") <= F.col("_high"), F.sequence(F.expr(f"(_low - 1) div {PIECE}"), F.expr(f"(_high - 1) div {PIECE}")))
    rows = rows.withColumn("_at", F.explode_outer(at)).withColumn("_at", F.col("_at") * PIECE)
    parts = pieces(seqs, size=PIECE).select(F.col("seq_id").alias("_id"), "offset", "piece")
    rows = rows.join(parts, (F.col("seq_id") == F.col("_id")) & (F.col("_at") == F.col("offset")), "left")
    first = F.greatest(F.col("_low") - F.col("offset"), F.lit(1))
    own = F.substring("piece", first.cast("int"), (F.col("_high") - F.col("offset") - first + 1).cast("int"))
    whole = rows.groupBy("_f").agg(F.first("id").alias("id"), F.first("_back").alias("_back"), F.array_sort(F.collect_list(F.struct("offset", own.alias("own")))).alias("_p"))
    bases = F.array_join(F.transform("_p", lambda x: x["own"]), "")
    return whole.select("id", F.when(F.col("_back"), sq.reverse_complement(bases)).otherwise(bases).alias("bases"))


def trimmed(reads: DataFrame, adapter: str) -> DataFrame:
    """Reads cut before the first occurrence of an adapter, quality alike."""
    at = F.instr("sequence", adapter)
    cut = lambda c: F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(F.col(c))
    quality = {"quality": cut("quality")} if "quality" in reads.columns else {}
    return reads.withColumns({"sequence": cut("sequence"), **quality})


def looks_bisulfite(reads: DataFrame, most: int = 10_000, share: float = 0.125) -> DataFrame:
    """Whether C makes up less than a share of the bases of the first ``most`` reads, which is the test's definition."""
    some = reads.orderBy("seq_id").limit(most)
    c = F.sum(F.length("sequence") - F.length(F.translate("sequence", "C", "")))
    return some.agg((F.try_divide(c, F.sum(F.length("sequence"))) < share).alias("bisulfite"))


def mates_agree(a: DataFrame, b: DataFrame) -> DataFrame:
    """Reads of two files without a mate in the other (read_id, missing_in)."""
    both = a.select("read_id").distinct().withColumn("a", F.lit(True)).join(b.select("read_id").distinct().withColumn("b", F.lit(True)), "read_id", "full")
    return both.where("a is null or b is null").select("read_id", F.when(F.col("a").isNull(), "a").otherwise("b").alias("missing_in"))


def match_positions(seqs: DataFrame, word: str) -> DataFrame:
    """All (also overlapping) matches of a word on both strands: seq_id, start, end, strand."""
    n = len(word)
    rc = word.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    x = F.expr(f"explode(filter(transform(sequence(1, body), i -> struct(i, substring(piece, i, {n}) as w)), x -> x.w in ('{word}', '{rc}')))")
    rows = _pieces_of_words(seqs, n).select("seq_id", "offset", x.alias("x"))
    strands = F.filter(F.array(F.when(F.col("x.w") == word, "+"), F.when(F.col("x.w") == rc, "-")), lambda s: s.isNotNull())
    start = (F.col("offset") + F.col("x.i")).cast("int")
    return rows.select("seq_id", start.alias("start"), (start + n - 1).alias("end"), F.explode(strands).alias("strand"))


def ordered_reads(reads: DataFrame, key: str = "read_id") -> DataFrame:
    """One row for each read id, in order."""
    first = reads.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*(c for c in reads.columns if c != key))))
    return first.where("_n = 1").drop("_n").orderBy(key)


def matched_letters(column: Column, letters: str) -> Column:
    """How many of a string's letters are among the given ones."""
    return F.length(column) - F.length(F.translate(column, letters, ""))
