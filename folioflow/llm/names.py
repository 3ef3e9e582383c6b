"""Spellings of one person's or organisation's name, linked.

Work is done on distinct names only, and within them on distinct words:

1. A name is parsed into full words and initials; titles, affiliation marks, case, accents and the
   order of the words do not count (a name is the *set* of its words, so every permutation of the
   words has one key). Short forms of given names and abbreviated words are written out.
2. A *trie join* finds all pairs of words within one slip (a letter added, lost, changed, or two
   swapped): words are sharded by one of their segments, which a slip cannot all touch, each shard
   is a trie, and every word runs through the tries of its shards as a Levenshtein automaton.
3. A word is a slip of another only if it is rarer: words that both occur beside ``ATTESTED`` other names
   or more, neither more than ``LOPSIDED`` times as often as the other, are two words, and so are two of the known
   given names; that holds for persons, where only one other word agrees. Equal words on equal support are left apart. In words of three and four letters a slip needs
   support besides: ``SHORT_LOPSIDED`` times as many papers for the right name.
   Of the names that differ from a name in one word and are better supported, it joins the best one, for
   each of its words; so a rare slip never links two well-known names. The set with the most papers
   stands for all. Middle initials must not contradict; a missing one is filled if only one is known.
4. A surname with an initial belongs to the only full name that fits; if several fit, to none.

Names are linked by keys, never compared pair by pair; a pair is made only of names already known
to be one. Null and blank names have no links. Repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.unicode_form import canonical
from folioflow.session import cut, remove, rewrite

#: Slips per word, the shortest word that may have one, and the trie words of a shard before it is split.
DISTANCE, SHORTEST, SHARD = 1, 5, 5000
ATTESTED, LOPSIDED, SHORT_LOPSIDED, SALTS = 3, 20, 5, 16

# Words before or after a name that are no part of it.
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "dame", "phd", "md", "msc", "bsc", "jr", "sr", "ing"}
# Words of an organisation's name that come and go.
FILLERS = {"the", "of", "for", "and", "at", "in", "de", "team", "group"}
# Words that only organisations have in their names, and words that belong to the surname after them.
ORGANISATIONS = {"the", "of", "for", "and", "at", "in", "team", "group", "university", "institute", "laboratory", "lab", "laboratories", "department", "centre", "center", "college", "school", "academy", "association", "society", "consortium", "foundation", "company", "corporation", "inc", "ltd", "research"}
PARTICLES = {"van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "el", "al", "bin", "ibn", "ter", "ten"}


def plain(word: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word.casefold()) if not unicodedata.combining(c))


def parse(name: str) -> tuple[list[str], list[str], list[str]]:
    """(full words, abbreviated words, initials) of a name, in their order.

    Full words written all in capitals beside others, or before a comma, are put last (the surname).
    """
    text = canonical(name)
    text = re.sub(r"(?:[\s,;]*[0-9*†‡§¶#]+)+$|[*†‡§¶]+|(?<=\w)[0-9]+(?:,[0-9]+)*", "", text)
    text = re.sub(r"(?<=\b\w\.)(?=\w)", " ", text)
    front, comma, back = text.partition(",")
    pieces = [(w, bool(comma) and i < len(front.split())) for i, w in enumerate((front + " " + back).split())]
    full, short, initials, late = [], [], [], []
    capitals = [w for w, _ in pieces if len(w.strip(".,")) > 1 and w.isupper()]
    mixed = any(len(w.strip(".,")) > 1 and not w.isupper() for w, _ in pieces)
    for w, first in pieces:
        bare = plain(re.sub(r"[^\w'’-]", "", w))
        if not bare or bare in TITLES:
            continue
        if len(bare) == 1:
            initials.append(bare)
        elif w.endswith("."):
            short.append(bare)
        elif first or (mixed and w in capitals):
            late.append(bare)
        else:
            full.append(bare)
    return full + late, short, initials


def parse_kind(name: str) -> tuple[bool, list[str], list[str], list[str]]:
    """(whether an organisation, full words, abbreviated words, initials).

    A person has at most three words after particles have joined their surname, none of them a word
    of organisations. Of three the one in the middle counts as a middle initial, written out.
    """
    full, short, initials = parse(name)
    if ORGANISATIONS & {*full, *short}:
        return True, full, short, initials
    joined, before = [], ""
    for i, w in enumerate(full):
        # A particle goes on in the next word; in the first place it may be a given name.
        if w in PARTICLES and i + 1 < len(full) and (i or initials):
            before += w
        else:
            joined.append(before + w)
            before = ""
    if len(joined) + len(short) > 3:
        return True, full, short, initials
    if len(joined) == 3:
        joined, initials = [joined[0], joined[2]], [joined[1][0], *initials]
    return False, joined, short, initials


class _Trie:
    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def longer(self, short: str) -> list[str]:
        """Longer words that begin with the first two letters of ``short`` and have its letters in order."""
        out, stack = [], [(self.root, 0, 0)]
        while stack:
            node, depth, seen = stack.pop()
            for c, child in node.items():
                if c == "":
                    if seen == len(short) and depth > len(short):
                        out.append(child)
                elif depth >= 2 or (depth < len(short) and short[depth] == c):
                    stack.append((child, depth + 1, seen + (seen < len(short) and short[seen] == c)))
        return out

    def near(self, word: str, most: int) -> list[tuple[str, int]]:
        """Words within ``most`` edits; swapping two neighbours is one edit.

        The state of the automaton after a prefix is the row of distances to those prefixes of ``word``
        whose length differs by at most ``most``; a branch whose row has nothing within ``most`` is left.
        """
        n, out, width, far = len(word), [], 2 * most + 1, most + 1
        stack = [(self.root, [j if 0 <= j <= n else far for j in range(-most, most + 1)], None, "", 0)]
        while stack:
            node, row, above, last, depth = stack.pop()
            for c, child in node.items():
                if c == "":
                    k = n - depth + most
                    if 0 <= k < width and row[k] <= most:
                        out.append((child, row[k]))
                    continue
                new: list[int] = []
                for k in range(width):
                    j = depth + 1 - most + k
                    if j < 0 or j > n:
                        d = far
                    elif j == 0:
                        d = depth + 1
                    else:
                        d = row[k] + (word[j - 1] != c)
                        if k:
                            d = min(d, new[k - 1] + 1)
                        if k + 1 < width:
                            d = min(d, row[k + 1] + 1)
                        if above is not None and j > 1 and word[j - 1] == last and word[j - 2] == c:
                            d = min(d, above[k] + 1)
                    new.append(min(d, far))
                if min(new) <= most:
                    stack.append((child, new, row, c, depth + 1))
        return out


def _segments(n: int, parts: int) -> list[tuple[int, int]]:
    edges = [n * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def _shards(most: int):
    """A word's shards as trie word (role 0) and as query (role 1). A slip touches at most two of three segments."""
    parts = 2 * most + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, role, words = [], [], []
            for w in b.column(0).to_pylist():
                mine = {(f"{len(w)}:{i}:{w[s:e]}", 0) for i, (s, e) in enumerate(_segments(len(w), parts))}
                for n in range(len(w) - most, len(w) + most + 1):
                    for i, (s, e) in enumerate(_segments(n, parts)):
                        mine |= {(f"{n}:{i}:{w[s + d : e + d]}", 1) for d in range(-most, most + 1) if 0 <= s + d and e + d <= len(w)}
                for s, r in sorted(mine):
                    shard.append(s), role.append(r), words.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.string()), pa.array(role, pa.int32()), pa.array(words, pa.string())], names=["shard", "role", "word"])

    return rows


def _search(find):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (shard, salt, role, word) -> (word, near): trie words come before queries."""
        key, held, trie = None, [], None
        for b in batches:
            word, near = [], []
            for shard, salt, role, w in zip(*(c.to_pylist() for c in b.columns)):
                if (shard, salt) != key:
                    key, held, trie = (shard, salt), [], None
                if role == 0:
                    held.append(w)
                elif held:
                    trie = trie or _Trie(held)
                    for other in find(trie, w):
                        word.append(w), near.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string())], names=["word", "near"])

    return search


def _sharded(rows: DataFrame, shard_words: int) -> DataFrame:
    """Rows (shard, role, word, ...) by shard, trie words (role 0) before queries (role 1).

    A shard with more than ``shard_words`` trie words is split into several tries, and its queries
    go to each of them.
    """
    big = cut(rows.where("role = 0").groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_words).select("shard", F.ceil(F.col("n") / shard_words).cast("int").alias("salts")))
    if big.isEmpty():
        salted = rows.withColumn("salt", F.lit(0))
    else:
        many = rows.join(big, "shard", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("word"), F.col("salts")).cast("int"))
        salted = many.withColumn("salt", F.explode(F.when(F.col("role") == 0, own).otherwise(F.sequence(F.lit(0), F.col("salts") - 1))))
    return salted.select("shard", "salt", "role", "word").repartition("shard", "salt").sortWithinPartitions("shard", "salt", "role", "word")


def near_words(words: DataFrame, most: int = DISTANCE, shard_words: int = SHARD) -> DataFrame:
    """(word) -> (word, near): all pairs of different words within ``most`` edits, in both directions."""
    rows = words.select("word").distinct().mapInArrow(_shards(most), "shard string, role int, word string")
    return _sharded(rows, shard_words).mapInArrow(_search(lambda trie, w: [o for o, d in trie.near(w, most) if d]), "word string, near string").distinct()


_PARSED = "name string, org boolean, full array<string>, short array<string>, initials array<string>"


def _parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.column(0).to_pylist()
        cols = list(zip(*map(parse_kind, names))) or [[], [], [], []]
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array(c, t) for c, t in zip(cols, (pa.bool_(), kind, kind, kind)))], names=["name", "org", "full", "short", "initials"])


def _spelled_out(words: DataFrame, known: DataFrame, shard_words: int = SHARD) -> DataFrame:
    """(short) -> (short, long): the most frequent known word that begins alike and has its letters in order."""
    shard = F.substring("word", 1, 2).alias("shard")
    rows = known.select(shard, F.lit(0).alias("role"), "word").unionByName(words.select(F.col("short").alias("word")).distinct().select(shard, F.lit(1).alias("role"), "word"))
    pair = _sharded(rows, shard_words).mapInArrow(_search(lambda trie, w: trie.longer(w)), "word string, near string")
    return pair.join(known.select(F.col("word").alias("near"), "n"), "near").groupBy(F.col("word").alias("short")).agg(F.max(F.struct("n", F.col("near").alias("word"))).alias("m")).select("short", F.col("m.word").alias("long"))


def _begun(words: DataFrame, known: DataFrame) -> DataFrame:
    """(short) -> (short, long): the most frequent longer known word that begins with it; words of three to five letters."""
    begins = known.select(F.explode(F.transform(F.sequence(F.lit(3), F.lit(5)), lambda n: F.when(n < F.length("word"), F.substring(F.col("word"), F.lit(1), n)))).alias("short"), "n", "word").where("short is not null")
    best = begins.groupBy("short").agg(F.max(F.struct("n", "word")).alias("m")).select("short", F.col("m.word").alias("long"))
    return words.select("short").distinct().join(best, "short")


def slip_edges(bags: DataFrame, known: DataFrame) -> DataFrame:
    """(bag, words, n) -> undirected (bag, to), both ways: each name and the best supported ones that it is a slip of.

    ``known`` has (word): given names that are words of their own whatever their support.
    """
    each = bags.where(F.size("words") > 1).select("bag", "n", F.posexplode("words").alias("at", "word"), "words").where(F.length("word") >= 3)
    open_at = cut(each.select("bag", "n", "word", F.array_join(F.filter("words", lambda w, i: i != F.col("at")), " ").alias("rest")))
    borne = open_at.groupBy("word").agg(F.count("*").alias("bearers")).join(known.select("word", F.lit(True).alias("known")), "word", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    other = borne.select(F.col("word").alias("near"), F.col("bearers").alias("near_bearers"), F.col("known").alias("near_known"))
    low, high = F.least("bearers", "near_bearers"), F.greatest("bearers", "near_bearers")
    two = (F.col("known") & F.col("near_known")) | ((low >= ATTESTED) & (LOPSIDED * low >= high))
    near = near_words(open_at.select("word")).join(borne, "word").join(other, "near").withColumn("two", two)
    # Salted: one surname may have a third of all names.
    near = near.select("word", "near", "bearers", "near_bearers", "two", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    apart = F.col("two") & ~F.col("rest").contains(" ")
    mine = open_at.withColumn("salt", F.pmod(F.xxhash64("rest"), F.lit(SALTS)).cast("int")).join(near, ["word", "salt"]).where(~apart)
    there = open_at.select(F.col("bag").alias("to"), F.col("n").alias("to_n"), F.col("word").alias("near"), "rest")
    both = mine.join(there, ["near", "rest"])
    short = (F.length("word") < SHORTEST) & (F.length("near") < SHORTEST)
    few, many = F.least("n", "to_n"), F.greatest("n", "to_n")
    told_apart = (F.col("bearers") != F.col("near_bearers")) | (F.col("n") != F.col("to_n"))
    found = cut(both.where(F.when(short, many >= SHORT_LOPSIDED * few).otherwise(told_apart)).select("bag", "n", "rest", "to", "to_n", "bearers", "near_bearers"))
    # The better supported one of a pair is the parent; support is papers, then how common the word is.
    up = found.where(F.struct("to_n", "near_bearers", "to") > F.struct("n", "bearers", "bag"))
    best = up.groupBy("bag", "rest").agg(F.max(F.struct("to_n", "near_bearers", "to")).alias("m")).select("bag", F.col("m.to").alias("to"))
    return best.unionByName(best.select(F.col("to").alias("bag"), F.col("bag").alias("to"))).distinct()


def _components(edges: DataFrame) -> DataFrame:
    """Undirected (bag, to), both ways -> (bag, root): the smallest bag that can be reached.

    Spellings of one name lie one or two slips apart, so few rounds are needed; each also follows
    the label's own label.
    """
    labels, at = rewrite(edges.groupBy("bag").agg(F.least(F.min("to"), F.first("bag")).alias("root")))
    while True:
        near = edges.join(labels.select(F.col("bag").alias("to"), F.col("root").alias("other")), "to").groupBy("bag").agg(F.min("other").alias("other"))
        jump = labels.select(F.col("bag").alias("root"), F.col("root").alias("beyond"))
        lower = labels.join(near, "bag").join(jump, "root", "left").select("bag", F.least("root", "other", "beyond").alias("root"))
        new, now = rewrite(lower)
        moved = new.join(labels, ["bag", "root"], "left_anti").isEmpty()
        remove(edges.sparkSession, at)
        labels, at = new, now
        if moved:
            done = cut(labels)
            remove(edges.sparkSession, at)
            return done


def entities(papers: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(name, entity, papers): spellings with the same entity name the same person or organisation."""
    listed = papers.select("paper_id", F.explode("authors").alias("name")).where("name is not null").groupBy("name").agg(F.count_distinct("paper_id").alias("papers"))
    parsed = cut(listed.select("name").mapInArrow(_parse_all, _PARSED).join(listed, "name").where(F.size("full") + F.size("short") > 0))
    is_org = F.col("org")
    words = parsed.select(is_org.alias("org"), F.explode("full").alias("word"), "papers").groupBy("org", "word").agg(F.sum("papers").alias("n"))

    # Organisations: abbreviations written out, fillers dropped.
    orgs = parsed.where(is_org)
    org_words = words.where("org").select("word", "n")
    dotted = orgs.select(F.explode("short").alias("short"))
    # A word without a stop is an abbreviation if a longer word begins with it.
    clipped = org_words.where("length(word) between 3 and 5").select(F.col("word").alias("short"))
    longer = cut(_spelled_out(dotted, org_words).unionByName(_begun(clipped, org_words)).groupBy("short").agg(F.max("long").alias("long")))
    org_each = orgs.select("name", "papers", F.explode(F.concat("full", "short")).alias("word")).where(~F.col("word").isin(*FILLERS))
    org_bags = org_each.join(longer, F.col("word") == F.col("short"), "left").groupBy("name", "papers").agg(F.array_sort(F.collect_set(F.coalesce("long", "word"))).alias("words"))
    org_bags = org_bags.select("name", "papers", "words", F.lit("").alias("middle"))

    # Persons: short forms of given names written out.
    person = parsed.where(~is_org)
    forms = name_forms.where("formal is not null and short is not null").select(F.lower("short").alias("nick"), F.lower("formal").alias("formal")).distinct()
    each = person.select("name", "papers", F.posexplode(F.concat("full", "short")).alias("at", "word"), F.size(F.concat("full", "short")).alias("words_in"), "initials")
    # A short form of several names stays as it is unless one of them occurs with the same other word.
    written = each.join(forms, (F.col("word") == F.col("nick")) & (F.col("at") == 0) & (F.col("words_in") == 2), "left")
    options = written.groupBy("name", "papers", "initials", "words_in").agg(F.array_sort(F.collect_set(F.when(F.col("at") > 0, F.col("word")))).alias("rest"), F.array_sort(F.collect_set(F.when(F.col("at") == 0, F.coalesce("formal", "word")))).alias("given"))
    choice = options.select("name", "papers", "initials", "words_in", F.explode("given").alias("g"), "rest")
    bagged = choice.select("name", "papers", "initials", "words_in", F.array_sort(F.array_distinct(F.concat("rest", F.array("g")))).alias("words"))
    support = bagged.groupBy("words").agg(F.sum("papers").alias("of_bag"))
    pick = Window.partitionBy("name").orderBy(F.desc("of_bag"), "words")
    person_bags = bagged.join(support, "words").withColumn("r", F.row_number().over(pick)).where("r = 1")
    full_names = person_bags.where("words_in = 2").select("name", "papers", "words", F.array_join("initials", "").alias("middle"))
    initialled = cut(person_bags.where("words_in = 1 and size(initials) > 0").select("name", "papers", F.col("words")[0].alias("surname"), F.col("initials")[0].alias("first"), F.array_join(F.slice("initials", 2, 99), "").alias("middle")))
    lone = person_bags.where("words_in = 1 and size(initials) = 0").select("name", "papers", "words", F.lit("").alias("middle"))

    bag = F.array_join("words", " ")
    named = cut(org_bags.unionByName(full_names).unionByName(lone).where(F.size("words") > 0).withColumn("bag", bag))
    bags = named.groupBy("bag", "words").agg(F.sum("papers").alias("n"))
    # Bags that agree in all words but one, and there by a slip.
    given = forms.select(F.explode(F.array("nick", "formal")).alias("word")).distinct()
    slips = cut(slip_edges(bags, given))
    # Of the bags that slips connect the best known one is the name.
    linked = cut(_components(slips).join(bags.select("bag", "n"), "bag"))
    best = linked.groupBy("root").agg(F.max_by("bag", F.struct("n", "bag")).alias("to"))
    rooted = named.join(linked.join(best, "root").select("bag", "to"), "bag", "left").select("name", "papers", F.coalesce("to", "bag").alias("bag"), "middle")

    # Middle initials.
    middles = rooted.where("middle <> ''").select("bag", "middle").distinct().groupBy("bag").agg(F.count("*").alias("kinds"), F.min("middle").alias("only"))
    whole = cut(rooted.join(middles, "bag", "left").select("name", "papers", "bag", F.when((F.col("middle") == "") & (F.col("kinds") == 1), F.col("only")).otherwise(F.col("middle")).alias("middle")))

    # Surname and initial: the only full name that fits.
    persons = whole.select("bag", "middle").distinct().where("size(split(bag, ' ')) = 2")
    parts = persons.select("bag", "middle", F.posexplode(F.split("bag", " ")).alias("at", "surname"))
    parts = parts.select("bag", F.col("middle").alias("full_middle"), "surname", F.substring(F.split("bag", " ")[1 - F.col("at")], 1, 1).alias("first"))
    fits = initialled.join(parts, ["surname", "first"]).where((F.col("middle") == "") | (F.col("full_middle") == "") | (F.col("middle") == F.col("full_middle")))
    one = fits.groupBy("name", "papers").agg(F.count("*").alias("k"), F.min(F.struct("bag", "full_middle")).alias("m"))
    # A surname that stands in no full name with this initial may be a slip of one that does.
    missing = cut(initialled.join(parts.select("surname", "first").distinct(), ["surname", "first"], "left_anti"))
    surnames = missing.select("surname").unionByName(parts.select("surname")).select(F.col("surname").alias("word")).where(F.length("word") >= SHORTEST - 1)
    meant = near_words(surnames).where((F.length("word") >= SHORTEST) | (F.length("near") >= SHORTEST)).select(F.col("word").alias("surname"), "near")
    slipped = missing.join(meant, "surname").join(parts.withColumnRenamed("surname", "near"), ["near", "first"]).where((F.col("middle") == "") | (F.col("full_middle") == "") | (F.col("middle") == F.col("full_middle")))
    slipped = slipped.select("name", "papers", "bag", "full_middle").distinct().groupBy("name", "papers").agg(F.count("*").alias("k"), F.min(F.struct("bag", "full_middle")).alias("m")).where("k = 1")
    one = cut(one.unionByName(slipped))
    found = one.where("k = 1").select("name", "papers", F.col("m.bag").alias("bag"), F.col("m.full_middle").alias("middle"))
    # With no full name the initials are the name; with several the spelling stays by itself.
    alone = initialled.join(one, ["name", "papers"], "left").select("name", "papers", F.when(F.col("k").isNull(), F.concat_ws(" ", F.col("first"), F.col("surname"))).otherwise(F.concat(F.lit("?"), F.col("name"))).alias("bag"), "middle").join(found.select("name"), "name", "left_anti")
    every = whole.unionByName(found).unionByName(alone.select(whole.columns))
    return every.select("name", F.concat_ws("/", "bag", "middle").alias("entity"), "papers")


def variant_pairs(papers: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b: all pairs of spellings of one entity."""
    e = cut(entities(papers, name_forms).select("name", "entity"))
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, (F.col("a.entity") == F.col("b.entity")) & (F.col("a.name") < F.col("b.name"))).select(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))
