"""Near-duplicate lines by a deletion-neighbourhood join; the earliest stays.

DataFrame functions only. The unit of an edit is a word changed, added or left out. The bound is
one edit or, with ``words_per_edit``, grows with the line: one edit in so many words of the
shorter line, at least one.
Words are compared by their 64-bit hashes.

One edit: a line's variants are the line without one of its words. Two lines of the same
length that differ in one word share the variant without that word's place; a line that lacks a
word of another is itself a variant of it. Variants are hashed keys, equal keys are joined
through their earliest line, and the edit distance is verified on the words. Emitting every
variant of every line would cost a key per word of the corpus. Lines within one edit have their
first or their last half in common, so lines that share neither half with any other line are
left out first; that loses none.

Several edits: all variants of a line without any k of its words would be too many, so a family
of variants is emitted that meets every choice of edits. A hash deals the words to 2k + 2 classes;
a variant is the line without all words but those of one class, in their order. An edit takes a
word and adds one, and so changes two variants at most: lines within the bound have two or more
variants in common, wherever the edits are and however far words move. A variant has words from
all over the line, so lines that only share a passage have none in common. A class without a word
says nothing, and all lines of few different words have such classes: only variants with words
are keys, and a line that lacks some has further ones, in which its words are dealt out one by one,
told apart by their rank among equals. Lines are first verified against the earliest line of each of their keys; those that stay, against the earlier
lines of their rarer keys. With as many keys as near lines must share, frequent ones aren't needed.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tables

#: Lines with fewer words stay, whatever they repeat: by default only those without a word.
LEAST_WORDS = 1
#: Lines with fewer words are only compared whole: one edit would change too much of them.
LEAST_NEAR_WORDS = 4
#: Words of a line for each edit that it may be from an earlier one, in op4_line_dedup.
WORDS_PER_EDIT = 16
#: Ratio of the lengths at which one number of classes of words gives way to the next.
RATIO = 1.25
#: Marks are broadcast up to this many documents and four times as many lines, else joined by a shuffle.
MOST_BROADCAST = 500_000
_LAST = (1 << 63) - 1
#: Bits of a key of several edits: that it is one of ranked words, that its line is poor.
_RANKED, _POOR = 4, 8
#: Words of 64 bits of a sketch, a power of two.
LANES = 4


def _keyed(documents: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key that tells rows of one id apart, and its column's name.

    The key is a hash of the text. Rows without an id are numbered, in a table that is written so
    that the numbers stay.
    """
    name = "row_key"
    while name in map(str.lower, documents.columns):
        name += "_"
    known = documents.where(documents["doc_id"].isNotNull())
    alone = documents.where(documents["doc_id"].isNull())
    numbered = tables.stored(alone.withColumn(name, F.monotonically_increasing_id()))
    return known.withColumn(name, F.xxhash64(known["text"])).union(numbered), name


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _places(rows: DataFrame, key: str) -> DataFrame:
    """Every line of every text in lower case, with its place. Lines end at line feeds.

    White space within a line is made blanks: parting at one character needs no pattern.
    """
    text = F.lower(F.coalesce("text", F.lit("")))
    odd = [F.contains(F.col("text"), F.lit(c)) for c in "\t\x0b\x0c\r"]
    plain = F.when(odd[0] | odd[1] | odd[2] | odd[3], F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    lines = rows.select(
        _order(F.col("doc_id")).alias("doc_id"), F.col(key).alias("row"), F.posexplode(F.split(plain, "\n")).alias("line_no", "line")
    )
    return lines.select(F.struct("doc_id", "row", "line_no").alias("at"), "line")


def _worded(places: DataFrame, least: int, *keep: str) -> DataFrame:
    """The lines that take part, as arrays of the hashes of their words (runs without white space).

    As the element of an exploded array the hashes are made once, not again for each use.
    """
    words = F.array_remove(F.transform(F.split("line", " "), lambda x: F.xxhash64(x)), F.xxhash64(F.lit("")))
    return places.select(*keep, "at", F.explode(F.array(words)).alias("w")).where(F.size("w") >= least)


def _halves(w: Column) -> Column:
    """Keys of the halves that a line shares with any line within one edit.

    For a partner with n words, the shorter of the two, the edit is in the first n div 2 words or
    behind them; so these words are equal, or the last n - n div 2 are. Keys of the first and the
    last half, for a line with n words itself and for one with n + 1.
    """

    def of(longer: int) -> list[Column]:
        n = F.size(w) - longer
        first = F.floor(n / 2).cast("int")
        rest = n - first
        keys = [F.slice(w, F.lit(1), first), F.slice(w, F.size(w) - rest + 1, rest)]
        return [F.xxhash64(n, F.lit(side), key) for side, key in enumerate(keys)]

    return F.array(*of(0), *of(1))


def _variants(w: Column, needs: Column) -> Column:
    """Hashed keys with roles: C for a word changed (place and length count), S for the line
    without a word, F for the full line that such a variant may equal.

    ``needs`` has what the line's shared halves leave open: C or S and the side that is equal, so
    that the edit is on the other, or F.
    """
    n = F.size(w)

    def without(h: Column) -> Column:
        def cut(i: Column) -> tuple[Column, Column]:
            return F.slice(h, F.lit(1), i - 1), F.slice(h, i + 1, n)

        def key(role: str, value: Column) -> Column:
            return F.struct(F.lit(role).alias("role"), value.alias("key"))

        def places(role: str, longer: int) -> Column:
            half = F.floor((n - longer) / 2).cast("int")  # words of the first half
            low = F.when(F.array_contains(needs, f"{role}1"), F.lit(1)).otherwise(half + 1)
            high = F.when(F.array_contains(needs, f"{role}0"), n).otherwise(half + longer)
            wanted = F.array_contains(needs, f"{role}0") | F.array_contains(needs, f"{role}1")
            return F.when(wanted & (low <= high), F.sequence(low, high)).otherwise(F.expr("array()").cast("array<int>"))

        changed = F.transform(places("C", 0), lambda i: key("C", F.xxhash64(F.lit(1), n, i, *cut(i))))
        shorter = F.transform(places("S", 1), lambda i: key("S", F.xxhash64(F.lit(2), F.concat(*cut(i)))))
        whole = F.when(F.array_contains(needs, "F"), F.array(key("F", F.xxhash64(F.lit(2), h))))
        return F.concat(changed, shorter, F.coalesce(whole, F.expr("array()").cast("array<struct<role:string,key:bigint>>")))

    return F.flatten(F.transform(F.array(w), without))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one change, addition or omission apart."""
    same = lambda x, y: F.zip_with(x, y, lambda p, q: p.eqNullSafe(q))
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def run(marks: Column) -> Column:
        at = F.array_position(marks, F.lit(False))
        return F.when(at == 0, long).otherwise(at - 1)

    front, back = run(same(a, b)), run(same(F.reverse(a), F.reverse(b)))
    changed = F.size(F.filter(same(a, b), lambda x: ~x)) <= 1
    return F.when(F.size(a) == F.size(b), changed).otherwise((long - short == 1) & (front + back >= short))


def _step(length: Column) -> Column:
    """Which number of classes a line has whose shorter partner has this length."""
    return F.floor(F.log(length.cast("double")) / log(RATIO)).cast("int")


def _classes(step: Column, words_per_edit: int) -> tuple[Column, Column, Column]:
    """Edits that the longest line of a step may have; groups of classes and classes of each."""
    most = F.floor((F.ceil(F.pow(F.lit(RATIO), step + 1)) - 1) / words_per_edit)
    groups = F.ceil(F.sqrt((2 * most + 2).cast("double"))).cast("long")
    return most, groups, F.ceil((2 * most + 2) / groups).cast("long")


def _ranked(w: Column) -> Column:
    """A hash of each word and its rank among equals: an edit takes one of them at most, and adds one."""
    n = F.size(w)

    def of(s: Column) -> Column:
        def told(starts: Column) -> Column:
            def run(start: Column, i: Column) -> Column:
                length = F.coalesce(F.get(starts, i + 1), n + 1) - start
                return F.transform(F.sequence(F.lit(1), length), lambda rank: F.xxhash64(F.element_at(s, start), rank))

            return F.flatten(F.transform(starts, run))

        first = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(s, i) != F.element_at(s, F.greatest(i - 1, F.lit(1)))))
        return F.element_at(F.transform(F.array(first), told), 1)

    return F.element_at(F.transform(F.array(F.sort_array(w)), of), 1)


def _kept_classes(w: Column, words_per_edit: int) -> Column:
    """Keys of which two lines within a bound of two or more edits have several in common.

    A key is the hash of a variant with the words of one class. The number of classes depends on
    the shorter line, by steps of RATIO; so a line has keys for every step that a shorter line
    within its bound can be in. Classes are made in two stages, groups and classes within them, so
    that a line of n words takes n times the root of their number.

    Classes without a word have no key. A line with such a class is poor, and has a second kind of
    keys, of the classes of its ranked words, without their order. Lines that aren't both poor share
    keys of the first kind, poor ones of the second. The lower bits of a key tell the step (two
    bits), the kind (``_RANKED``) and whether the line is poor (``_POOR``, which isn't part of the key).
    """
    n = F.size(w)

    def dealt(step: Column) -> Column:
        _, groups, each = _classes(step, words_per_edit)
        return F.struct(step.alias("step"), groups.alias("groups"), each.alias("each"))

    def upto(count: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), count - 1)

    def marked(hashed: Column, s: Column, marks: int) -> Column:
        return hashed.bitwiseAND(F.lit(-16)).bitwiseOR(s["step"].cast("long").bitwiseAND(F.lit(3)) + marks)

    def variants(w: Column, s: Column) -> Column:
        """Of each class its hash, null for one without a word."""

        def of(group: Column) -> Column:
            def kept(part: Column, number: Column) -> Column:
                return F.filter(part, lambda x: F.pmod(F.shiftright(x, 24), s["each"]) == number)

            def key(words: Column, number: Column) -> Column:
                return F.when(F.size(words) > 0, F.xxhash64(s["step"], group, number, words))

            mine = F.filter(w, lambda x: F.pmod(x, s["groups"]) == group)
            return F.flatten(F.transform(F.array(mine), lambda part: F.transform(F.transform(upto(s["each"]), lambda i: kept(part, i)), key)))

        return F.flatten(F.transform(upto(s["groups"]), of))

    def keys(s: Column) -> Column:
        def told(found: Column) -> Column:
            known = F.array_compact(found)
            ranked = F.transform(variants(F.sort_array(_ranked(w)), s), lambda x, i: F.coalesce(x, F.xxhash64(s["step"], i)))
            poor = F.concat(
                F.transform(known, lambda x: marked(x, s, _POOR)), F.transform(ranked, lambda x: marked(x, s, _RANKED + _POOR))
            )
            return F.when(F.size(known) < F.size(found), poor).otherwise(F.transform(known, lambda x: marked(x, s, 0)))

        return F.element_at(F.transform(F.array(variants(w, s)), told), 1)

    shortest = F.greatest(n - F.floor(n / (words_per_edit + 1)).cast("int"), F.lit(2 * words_per_edit))
    steps = F.transform(F.sequence(_step(F.least(shortest, n)), _step(n)), dealt)
    return F.flatten(F.transform(steps, keys))


def _common(key: Column, n: Column, words_per_edit: int) -> Column:
    """Keys of the key's step, at least, that a line of n words shares with any line within its bound.

    Each edit turns two keys at most.
    """
    step = _step(n) - F.pmod(_step(n) - key.bitwiseAND(F.lit(3)).cast("int"), F.lit(4))
    most, groups, each = _classes(step, words_per_edit)
    return groups * each - 2 * F.least(F.floor(n / words_per_edit), most)


def _sketch(w: Column) -> Column:
    """LANES times 64 bits, each the parity of some ranked words: an edit turns two bits at most.

    Without their ranks, words that a line has an even number of times would leave no trace. Where
    two changed words meet in one bit, lines beyond the bound seem nearer: more bits, fewer of them.
    """
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))

    def lane(ranked: Column, number: int) -> Column:
        mine = F.filter(ranked, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(LANES - 1)) == number)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda sum_, x: sum_.bitwiseXOR(bit(x)))

    return F.element_at(F.transform(F.array(_ranked(w)), lambda r: F.array(*[lane(r, i) for i in range(LANES)])), 1)


def _turned(a: Column, b: Column) -> Column:
    """Bits that two sketches differ in."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, LANES)), F.bit_count(a[0].bitwiseXOR(b[0])))


def _letter(number: Column) -> Column:
    """A code point for each number from 1, surrogates left out, as eight hexadecimal digits."""
    return F.lpad(F.hex(F.when(number <= 0xD7FF, number).otherwise(number + 0x800).cast("long")), 8, "0")


def _spelt(letters: Column) -> Column:
    return F.decode(F.unhex(F.array_join(letters, "")), "UTF-32")


def _letters(w: Column) -> Column:
    """A text with a letter for each word; equal words have equal letters, and few others do."""
    return _spelt(F.transform(w, lambda x: _letter(F.pmod(x, F.lit(0x10F000)) + 1)))


def _edits(a: Column, b: Column, most: Column) -> Column:
    """Word edits between two arrays, -1 if more than ``most``: each distinct word as a letter."""

    def told(numbers: Column) -> Column:
        letters = lambda w: _spelt(F.transform(w, lambda x: _letter(F.element_at(numbers, x))))
        return F.call_function("levenshtein", letters(a), letters(b), most)

    words = F.array_distinct(F.concat(a, b))
    numbers = F.map_from_arrays(words, F.sequence(F.lit(1), F.size(words)))
    return F.element_at(F.transform(F.array(numbers), told), 1)


def _far_edited(words: DataFrame, shared: DataFrame, scratch: tables.Scratch, words_per_edit: int) -> DataFrame:
    """``at`` of the lines that an earlier one is within a bound of two or more edits of.

    ``words`` has their words, ``shared`` the keys (key, at, n, poor) that several lines have.
    """
    bound = F.floor(F.least("n", "fn") / words_per_edit).cast("int")
    carried = ("at", "n", "sketch", "poor")
    other = [F.col(c).alias(f"f{c}") for c in carried]
    shared = shared.join(words.select("at", "sketch"), "at")

    def verified(pairs: DataFrame) -> DataFrame:
        able = (F.abs(F.col("n") - F.col("fn")) <= bound) & (_turned(F.col("sketch"), F.col("fsketch")) <= 2 * bound)
        able &= ~(F.col("poor") & F.col("fpoor")) | (F.col("key").bitwiseAND(F.lit(_RANKED)) > 0)
        able = scratch.stored(pairs.where((F.col("fat") < F.col("at")) & able).select("at", "n", "fat", "fn").distinct())

        def joined(pairs: DataFrame, column: str) -> DataFrame:
            mine = words.select("at", F.col(column).alias("mine"))
            theirs = words.select(F.col("at").alias("fat"), F.col(column).alias("theirs"))
            return pairs.join(mine, "at").join(theirs, "fat")

        # Letters that two words share can only bring lines nearer to one another.
        near = joined(able, "letters").where(F.call_function("levenshtein", "mine", "theirs", bound) >= 0)
        near = joined(scratch.stored(near.select("at", "n", "fat", "fn")), "w")
        return near.where(_edits(F.col("mine"), F.col("theirs"), bound) >= 0).select("at").distinct()

    least = shared.groupBy("key").agg(F.min(F.struct(*carried)).alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    first = [F.col(f"first.{c}").alias(f"f{c}") for c in carried]
    led = scratch.stored(shared.join(least, "key").select("key", *carried, "members", *first))
    settled = scratch.stored(verified(led))
    # Near lines have a key in common that isn't among the most frequent of either: of all they
    # share, the rarest. Keys that no other line has are rarer still.
    mine = Window.partitionBy("at", F.col("key").bitwiseAND(F.lit(_RANKED + 3)))
    place = F.row_number().over(mine.orderBy("members", "key"))
    ranked = led.withColumn("place", place).withColumn("have", F.count(F.lit(1)).over(mine))
    rarer = ranked.where(F.col("place") <= F.col("have") - _common(F.col("key"), F.col("n"), words_per_edit) + 1)
    index = scratch.stored(rarer.where("members > 2").select("key", *carried))
    open_ = index.join(settled, "at", "left_anti")
    return settled.unionByName(verified(open_.join(index.select("key", *other), "key")))


def repeated_lines(
    rows: DataFrame, key: str, scratch: tables.Scratch, *, least_words: int = LEAST_WORDS,
    least_near_words: int = LEAST_NEAR_WORDS, words_per_edit: int | None = None,
) -> DataFrame:
    """(doc_id, row, line_no) of every line of ``least_words`` words that has an earlier line equal or near.

    Near are lines of ``least_near_words`` or more that are at most one edit apart, or with
    ``words_per_edit`` one in so many words of the shorter if that is more.

    Earlier is by doc_id, then the row's key (``row``), then line number; a null doc_id (here the
    largest long) is last. Rows with equal id and key are one row that is given several times, so
    neither's lines go for the other's.
    The result reads tables in the scratch folder.
    """
    if words_per_edit is not None and words_per_edit < 2:
        raise ValueError("words_per_edit must be 2 or more")
    least = max(1, least_words)
    several = max(2 * words_per_edit, least_near_words) if words_per_edit else None
    found = _worded(_places(rows, key), least)
    n, w = F.size("w"), F.col("w")
    far = [F.when(n >= several, _kept_classes(w, words_per_edit)).alias("kept")] if several else []
    small = scratch.stored(found.select(
        "at", F.xxhash64("w").alias("h"), F.hash("w").alias("g"), F.when(n >= least_near_words, n).alias("words"),
        F.when(n.between(least_near_words, several) if several else n >= least_near_words, _halves(w)).alias("halves"), *far,
    ))
    first = scratch.stored(small.groupBy("h", "g").agg(
        F.min("at").alias("at"), F.first("words").alias("words"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("n")
    ))
    near = first.where("halves is not null").select("at", F.posexplode("halves").alias("i", "half"))
    near = near.select("at", "half", F.floor(F.col("i") / 2).alias("longer"), (F.col("i") % 2).alias("side"))
    shared = near.groupBy("half").agg(
        F.count_if(F.col("longer") == 0).alias("own"), F.count_if(F.col("longer") == 1).alias("more")
    ).where("own > 1 or own > 0 and more > 0")
    side = F.col("side").cast("string")
    need = F.when(F.col("longer") == 1, F.array(F.concat(F.lit("S"), side))).otherwise(
        F.array(F.when(F.col("own") > 1, F.concat(F.lit("C"), side)), F.when(F.col("more") > 0, F.lit("F")))
    )
    open_ends = near.join(shared, "half").select("at", F.explode(F.array_compact(need)).alias("need"))
    if several:
        lines = small.where("kept is not null")
        told = F.col("kept").bitwiseAND(F.lit(~_POOR)).alias("key"), (F.col("kept").bitwiseAND(F.lit(_POOR)) > 0).alias("poor")
        keys = lines.select("h", F.explode("kept").alias("kept")).select("h", *told)
        common = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.min("poor").alias("poor"))
        of_use = ~F.col("poor") | (F.col("key").bitwiseAND(F.lit(_RANKED)) > 0)
        common = scratch.stored(common.where((F.col("low") != F.col("high")) & of_use).select("key"))
        few = common.limit(4 * MOST_BROADCAST + 1).count() <= 4 * MOST_BROADCAST
        keys = lines.select("h", "g", "at", "words", F.explode("kept").alias("kept")).select("h", "g", "at", "words", *told)
        keys = keys.join(F.broadcast(common) if few else common, "key")
        keys = keys.groupBy("key", "h", "g").agg(F.min("at").alias("at"), F.first("words").alias("n"), F.first("poor").alias("poor"))
        mine = Window.partitionBy("at", F.col("key").bitwiseAND(F.lit(_RANKED + 3)))
        keys = keys.select("key", "at", "n", "poor", F.count(F.lit(1)).over(mine).alias("have"))
        far_keys = scratch.stored(keys.where(F.col("have") >= _common(F.col("key"), F.col("n"), words_per_edit)).drop("have"))
        open_ends = open_ends.unionByName(far_keys.select("at", F.lit("R").alias("need")).distinct())
    maybe = scratch.stored(open_ends.groupBy("at").agg(F.collect_set("need").alias("needs")))
    few = maybe.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    places = _places(rows, key)
    wanted = _worded(places.join(F.broadcast(maybe) if few else maybe, "at"), least, "needs")
    # A row that is given several times puts its lines in one place.
    wanted = wanted.dropDuplicates(["at"])
    if several:
        far = F.array_contains("needs", "R")
        wanted = wanted.withColumns({"letters": F.when(far, _letters(F.col("w"))), "sketch": F.when(far, _sketch(F.col("w")))})
    words = scratch.stored(wanted)

    keys = words.where("size(array_remove(needs, 'R')) > 0").select("at", F.explode(_variants(F.col("w"), F.col("needs"))).alias("v")).select("at", "v.role", "v.key")
    role = lambda r: F.min(F.when(F.col("role") == r, F.col("at")))
    earliest = keys.groupBy("key").agg(
        role("C").alias("c"), role("S").alias("s"), role("F").alias("f"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    other = F.when(F.col("role") == "C", F.col("c")).when(F.col("role") == "S", F.col("f")).otherwise(F.col("s"))
    pairs = keys.join(earliest, "key").withColumn("fat", other).where("fat is not null and fat < at").select("at", "fat").distinct()
    mine = words.select("at", F.col("w").alias("mine"))
    theirs = words.select(F.col("at").alias("fat"), F.col("w").alias("theirs"))
    edited = pairs.join(mine, "at").join(theirs, "fat").where(_within_one_edit(F.col("mine"), F.col("theirs")))
    gone = edited.select("at")
    if several:
        gone = scratch.stored(gone)
        gone = gone.unionByName(_far_edited(words.where("array_contains(needs, 'R')"), far_keys, scratch, words_per_edit))
    gone = gone.distinct().withColumn("near", F.lit(True))

    # A line goes if it isn't the first of its equals, or if they all go for an earlier near one.
    judged = first.select("h", "g", "at", "n").join(gone, "at", "left").where("n > 1 or near").withColumnRenamed("at", "first_at")
    marked = small.select("at", "h", "g").join(judged, ["h", "g"]).where("near or at > first_at")
    return marked.select("at.doc_id", "at.row", "at.line_no")


def _with_marks(documents: DataFrame, **bounds: int) -> tuple[DataFrame, Column]:
    """The documents joined with the line numbers that go, and that column (null: none go)."""
    scratch = tables.Scratch(documents.sparkSession)
    rows, key = _keyed(documents)
    marks = repeated_lines(rows, key, scratch, **bounds).groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("gone"))
    marks = scratch.settled(marks.toDF("marked_doc", "marked_row", "marked_lines"))
    count, numbers = marks.agg(F.count(F.lit(1)), F.sum(F.size("marked_lines"))).first()
    few = count <= MOST_BROADCAST and (numbers or 0) <= 4 * MOST_BROADCAST
    same = (_order(rows["doc_id"]) == marks["marked_doc"]) & (rows[key] == marks["marked_row"])
    return rows.join(F.broadcast(marks) if few else marks, same, "left"), marks["marked_lines"]


def _left(text: Column, gone: Column) -> Column:
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup_lines(documents: DataFrame, drop_emptied: bool = False, **bounds: int) -> DataFrame:
    """The documents without the lines that :func:`repeated_lines` names; order and columns stay.

    n_chars, where there is one, becomes the new text's length. A text that loses no line stays
    as it is, to the byte. With ``drop_emptied``, documents that lost lines and have no word left
    go. Null texts stay null, empty ones empty; lines without a
    word stay, and so do those of fewer than ``least_words``; its other bounds can be given, too. Rows with the
    same doc_id and different texts, and rows without one, are rows of their own; rows with equal
    doc_id and text are left alike. Extra
    columns are kept, whatever their names.
    """
    joined, gone = _with_marks(documents, **bounds)
    text = _left(joined["text"], gone)
    if drop_emptied:
        joined = joined.where(gone.isNull() | text.rlike(tables.WORD))
    new = {"text": text}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(gone.isNull(), joined["n_chars"]).otherwise(F.length(text).cast("long"))
    return joined.select(*[new.get(c, joined[c]).alias(c) for c in documents.columns])


def line_report(documents: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, n_lines, n_removed and text_left for every document, as :func:`dedup_lines` leaves it."""
    joined, gone = _with_marks(documents.select("doc_id", "text"), **bounds)
    text = F.col("text")
    return joined.select(
        "doc_id", F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_removed"), _left(text, gone).alias("text_left"),
    )
