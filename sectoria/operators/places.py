"""Place lists, obsolete codes and the places of persons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, small_table


def _merged(left: DataFrame, right: DataFrame, key: str, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    joined = left.alias("a").join(right.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    code = F.coalesce(f"a.{key}", f"b.{key}").alias(key)
    return joined.select(code, *[value.alias(name) for name, value in columns])


def either(name: str, other: str | None = None) -> tuple[str, Column]:
    """Value of the first list, else of the second (where it may have another name)."""
    return name, F.coalesce(f"a.{name}", f"b.{other or name}")


def merge_place_lists(main: DataFrame, yearly: DataFrame) -> DataFrame:
    """Main postal list completed by the yearly list, one full outer join on the code."""
    empty = F.lit("")
    columns = [
        either("nom_commune_postal", "nom_commune"),
        ("code_postal", F.coalesce("a.code_postal", empty)),
        either("latitude"),
        either("longitude"),
        either("code_commune"),
        ("code_departement", F.coalesce("a.code_departement", "b.code_departement", empty)),
        either("nom_departement"),
        ("code_region", F.coalesce("a.code_region", "b.code_region", empty)),
        either("nom_region"),
    ]
    return _merged(main, yearly, "num_insee", columns)


def all_places(main: DataFrame, overseas: DataFrame, countries: DataFrame) -> DataFrame:
    """Main list, overseas list and countries as one place table of distinct rows.

    A main row whose department code is missing or ``098`` gets the overseas
    code ``988``, one without a region code ``98``.
    """
    is_main = F.col("a.num_insee").isNotNull()
    department = F.col("a.code_departement")
    region = F.col("a.code_region")
    with_overseas = _merged(
        main,
        overseas,
        "num_insee",
        [
            either("nom_commune_postal", "commune"),
            either("nom_departement"),
            either("nom_region"),
            either("latitude"),
            either("longitude"),
            (
                "code_departement",
                F.when(is_main & (department.isNull() | department.isin("nan", "098")), "988").otherwise(department),
            ),
            ("code_region", F.when(is_main & (region.isNull() | (region == "nan")), "98").otherwise(region)),
        ],
    ).distinct()
    return _merged(
        with_overseas,
        countries,
        "num_insee",
        [
            either("nom_commune_postal", "nom_pays_fr"),
            either("nom_departement", "nom_pays_fr"),
            either("nom_region", "nom_pays_fr"),
            either("latitude"),
            either("longitude"),
            ("code_departement", F.col("a.code_departement")),
            ("code_region", F.col("a.code_region")),
        ],
    ).distinct()


def _distinct_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        F.col("num_insee_avant").alias("avant"),
        F.col("nom_commune_en_clair_avant").alias("nom_avant"),
        F.col("num_insee_apres").alias("apres"),
        F.col("nom_commune_en_clair_apres").alias("nom_apres"),
    ).distinct()


def _stored_with(df: DataFrame, measure: Column) -> tuple[DataFrame, int]:
    """The stored rows and one measure of them, taken while they are written."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, measure.alias("measure")))
    return stored, seen.get["measure"]


def code_chains(changes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All chains of code changes: origin, last code, length and path.

    Chains are followed to their end, or to ``max_depth`` changes; a chain never returns to a code on its path. Every round
    doubles their length: the longest chains so far go on by all chains that start at their end. So a chain of n changes
    takes log2 n rounds.
    """
    chains, grown = cut_lineage(
        _distinct_changes(changes).select(
            F.col("avant").alias("origine"),
            F.col("nom_avant").alias("nom_origine"),
            F.col("apres").alias("actuel"),
            F.col("nom_apres").alias("nom_actuel"),
            F.lit(1).alias("niveau"),
            F.array("avant", "apres").alias("chemin"),
        )
    ), 1
    length = 1
    while grown and (max_depth is None or length < max_depth):
        longest = chains.where(F.col("niveau") == length).alias("a")
        onward = (chains if max_depth is None else chains.where(F.col("niveau") <= max_depth - length)).alias("b")
        beyond = F.slice("b.chemin", 2, F.col("b.niveau"))
        meets = (F.col("a.actuel") == F.col("b.origine")) & ~F.arrays_overlap("a.chemin", beyond)
        longer, grown = _stored_with(
            longest.join(onward, meets)
            .select(
                "a.origine",
                "a.nom_origine",
                "b.actuel",
                "b.nom_actuel",
                (F.col("a.niveau") + F.col("b.niveau")).alias("niveau"),
                F.concat("a.chemin", beyond).alias("chemin"),
            )
            .distinct(),
            F.coalesce(F.count_if(F.col("niveau") == 2 * length), F.lit(0)),
        )
        chains, length = chains.unionByName(longer), length * 2
    return chains


def _longest(chains: DataFrame) -> DataFrame:
    """Longest chain of each origin; ties by code, then names."""
    order = F.struct((-F.col("niveau")).alias("n"), "actuel", "nom_actuel", "nom_origine")
    return (
        chains.groupBy("origine")
        .agg(F.min_by(F.struct("nom_origine", "actuel", "nom_actuel", "niveau"), order).alias("l"))
        .select("origine", "l.*")
    )


def latest_codes(chains: DataFrame) -> DataFrame:
    """Longest chain of each origin; ties by code, then names."""
    return _longest(chains).select(
        F.col("origine").alias("num_insee_invalide"),
        F.col("nom_origine").alias("nom_invalide"),
        F.col("actuel").alias("num_insee_valide"),
        F.col("nom_actuel").alias("nom_valide"),
    )


def _followed(arcs: DataFrame) -> DataFrame:
    """Where codes with one successor each lead: ``at``, by how many ``steps``, and whether it is ``open`` (in or before a cycle).

    Every round each pointer is replaced by that of the code it points to. Unless cycles alone are left, some pointers come to
    their end in every round.
    """
    pointers, moving, before = arcs.select(
        F.col("avant").alias("origine"),
        F.col("apres").alias("at"),
        F.col("nom_apres").alias("nom_at"),
        F.lit(1).cast("long").alias("steps"),
        F.lit(True).alias("open"),
    ), -1, None
    while moving and moving != before:
        before, further = moving, F.col("q.origine").isNotNull()
        pointers, moving = _stored_with(
            pointers.alias("p")
            .join(pointers.alias("q"), F.col("p.at") == F.col("q.origine"), "left")
            .select(
                "p.origine",
                F.coalesce("q.at", "p.at").alias("at"),
                F.when(further, F.col("q.nom_at")).otherwise(F.col("p.nom_at")).alias("nom_at"),
                (F.col("p.steps") + F.coalesce("q.steps", F.lit(0))).alias("steps"),
                further.alias("open"),
            ),
            F.coalesce(F.count_if(F.col("open")), F.lit(0)),
        )
    return pointers


def latest_of_changes(changes: DataFrame) -> DataFrame:
    """What :func:`latest_codes` gives for all chains of ``changes``, without listing the chains.

    Codes with one successor all the way to a last code are followed by pointers that double. Only codes from which a code
    with several successors, or a cycle, can be reached have their chains listed, and only among each other: once a chain
    leaves them, the rest is one pointer. Changes without an old code are left out.
    """
    known = _distinct_changes(changes).where(F.col("avant").isNotNull())
    # Of several names for one change the first takes part; both names of a chain of one change come from one row.
    names = [
        F.min(F.struct("nom_avant"))["nom_avant"].alias("nom_avant"),
        F.min(F.struct("nom_apres"))["nom_apres"].alias("nom_apres"),
        F.min(F.struct("nom_apres", "nom_avant"))["nom_avant"].alias("nom_seul"),
    ]
    # A change of a code to itself only matters as the first one of a chain.
    ways = F.count_if(F.col("avant") != F.col("apres")).over(Window.partitionBy("avant"))
    reduced = cut_lineage(known.groupBy("avant", "apres").agg(*names).withColumn("ways", ways))
    arcs = reduced.where("avant <> apres")
    pointers = _followed(arcs.where("ways = 1"))
    branching = arcs.where("ways > 1").select(F.col("avant").alias("at")).distinct()
    plain = cut_lineage(pointers.where("NOT open").join(branching, "at", "left_anti"))
    first = arcs.select(F.col("avant").alias("origine"), "nom_avant", "nom_seul")
    straight = (
        plain.join(first, "origine")
        .withColumn("nom_origine", F.when(F.col("steps") == 1, F.col("nom_seul")).otherwise(F.col("nom_avant")))
        .select("origine", "nom_origine", F.col("at").alias("actuel"), F.col("nom_at").alias("nom_actuel"), F.col("steps").alias("niveau"))
    )
    of_plain = plain.withColumnRenamed("origine", "avant")
    mixed, several = _stored_with(arcs.join(of_plain, "avant", "left_anti"), F.count(F.lit(1)))
    chains = straight
    if several:
        codes = mixed.select(F.col("avant").alias("apres")).distinct()
        within = mixed.join(codes, "apres", "left_semi")
        # Chains that leave the listed codes end where the pointer of their next code does.
        ends = plain.select(F.col("origine").alias("apres"), "at", "nom_at", "steps")
        leaving = (
            mixed.join(codes, "apres", "left_anti")
            .join(ends, "apres", "left")
            .select(
                "avant",
                "nom_avant",
                "nom_seul",
                F.coalesce("at", "apres").alias("actuel"),
                F.when(F.col("steps").isNull(), F.col("nom_apres")).otherwise(F.col("nom_at")).alias("nom_actuel"),
                (F.coalesce("steps", F.lit(0)) + 1).alias("niveau"),
            )
        )
        listed = code_chains(
            within.select(
                F.col("avant").alias("num_insee_avant"),
                F.col("nom_avant").alias("nom_commune_en_clair_avant"),
                F.col("apres").alias("num_insee_apres"),
                F.col("nom_apres").alias("nom_commune_en_clair_apres"),
            )
        ).drop("chemin")
        names = ["origine", "nom_origine", "actuel", "nom_actuel", "niveau"]
        alone = F.when(F.col("niveau") == 1, F.col("nom_seul")).otherwise(F.col("nom_avant"))
        left = leaving.select(F.col("avant").alias("origine"), alone.alias("nom_origine"), "actuel", "nom_actuel", "niveau")
        one = within.select(
            F.col("avant").alias("origine"),
            F.col("nom_seul").alias("nom_origine"),
            F.col("apres").alias("actuel"),
            F.col("nom_apres").alias("nom_actuel"),
            F.lit(1).cast("long").alias("niveau"),
        )
        more = listed.where("niveau > 1").select(*names)
        out = (
            listed.alias("c")
            .join(leaving.alias("l"), F.col("c.actuel") == F.col("l.avant"))
            .select("c.origine", "c.nom_origine", "l.actuel", "l.nom_actuel", (F.col("c.niveau") + F.col("l.niveau")).alias("niveau"))
        )
        for part in (left, one, more, out):
            chains = chains.unionByName(part)
    best = _longest(chains)
    loops = reduced.where("avant = apres").select(
        F.col("avant").alias("origine"), F.col("nom_avant").alias("tour"), F.col("nom_apres").alias("nom_tour"), F.col("nom_seul").alias("tour_seul")
    )
    joined = best.join(loops.withColumn("is_loop", F.lit(True)), "origine", "full_outer")
    has_chain = F.col("niveau").isNotNull()
    with_loops = joined.select(
        "origine",
        F.when(has_chain & F.col("is_loop"), F.col("tour")).when(has_chain, F.col("nom_origine")).otherwise(F.col("tour_seul")).alias("nom_origine"),
        F.when(has_chain, F.col("actuel")).otherwise(F.col("origine")).alias("actuel"),
        F.when(has_chain, F.col("nom_actuel")).otherwise(F.col("nom_tour")).alias("nom_actuel"),
        (F.coalesce("niveau", F.lit(0)) + F.coalesce(F.col("is_loop").cast("int"), F.lit(0))).alias("niveau"),
    )
    # A change to no code is a chain of one change.
    ended = reduced.where(F.col("apres").isNull()).select(
        F.col("avant").alias("origine"),
        F.col("nom_seul").alias("nom_origine"),
        F.col("apres").alias("actuel"),
        F.col("nom_apres").alias("nom_actuel"),
        F.lit(1).cast("long").alias("niveau"),
    )
    return latest_codes(with_loops.unionByName(ended))


SEARCH_COLUMNS = (
    "num_insee_search num_insee_valide commune_valide origine latitude longitude code_departement nom_departement code_region nom_region"
).split()


def search_table(places: DataFrame, latest: DataFrame) -> DataFrame:
    """Every known code with its valid code and the place of the valid code.

    The origin flag is ``PR`` for codes that only the change table knows and
    ``MV`` for codes of the place table, as in the data this table replaces.
    """
    codes = (
        places.select("num_insee", "nom_commune_postal")
        .join(latest, F.col("num_insee") == F.col("num_insee_invalide"), "full_outer")
        .select(
            F.coalesce("num_insee", "num_insee_invalide").alias("num_insee_search"),
            F.coalesce("num_insee", "num_insee_valide").alias("num_insee_valide"),
            F.coalesce("nom_commune_postal", "nom_valide").alias("commune_valide"),
            F.when(F.col("num_insee").isNull(), "PR").otherwise("MV").alias("origine"),
        )
    )
    return codes.join(
        places.drop("nom_commune_postal"), F.col("num_insee_valide") == F.col("num_insee"), "left"
    ).select(
        "num_insee_search",
        "num_insee_valide",
        F.upper("commune_valide").alias("commune_valide"),
        "origine",
        "latitude",
        "longitude",
        "code_departement",
        F.upper("nom_departement").alias("nom_departement"),
        "code_region",
        F.upper("nom_region").alias("nom_region"),
    )


def one_row_per_code(search: DataFrame) -> DataFrame:
    """First row of each code by latitude, longitude and name."""
    order = F.struct("latitude", "longitude", "commune_valide", "num_insee_valide", "code_departement", "code_region")
    row = F.struct(*[c for c in search.columns if c != "num_insee_search"])
    return search.groupBy("num_insee_search").agg(F.min_by(row, order).alias("r")).select("num_insee_search", "r.*")


def locate_persons(persons: DataFrame, search: DataFrame, keep_all: bool = False) -> DataFrame:
    """Attach the birth and the death place and the three native flags.

    Both lookups run on the same row, so no join on the person id is needed.
    A code with several places uses its first one; ``keep_all=True`` keeps
    every combination. The place table joins by broadcast only while it is
    below the session's broadcast limit; beyond it, adaptive execution splits
    the partitions of frequent codes. It is stored, so that its size is known
    before the persons are moved for the join.
    """
    lookup = cut_lineage(search if keep_all else one_row_per_code(search))
    located = persons
    for side in ("naissance", "deces"):
        place = lookup.select(
            F.col("num_insee_search").alias("_search"),
            F.col("num_insee_valide").alias("_valid"),
            F.col("commune_valide").alias("_city"),
            F.col("latitude").alias(f"latitude_{side}"),
            F.col("longitude").alias(f"longitude_{side}"),
            *[
                F.col(c).alias(f"{c}_{side}")
                for c in ("code_departement", "nom_departement", "code_region", "nom_region")
            ],
        )
        located = (
            located.join(place, F.col(f"num_insee_{side}") == F.col("_search"), "left")
            .withColumn(f"num_insee_{side}", F.coalesce("_valid", f"num_insee_{side}"))
            .withColumn(f"ville_{side}", F.coalesce("_city", f"ville_{side}"))
            .drop("_search", "_valid", "_city")
        )
    return with_native_flags(located)


# Flags of a located person and the names whose equality they tell.
FLAG_NAMES = {"origine_ville": "ville", "origine_departement": "nom_departement", "origine_region": "nom_region"}


def count_all_matches(persons: DataFrame, search: DataFrame) -> DataFrame:
    """Combinations of a person with a birth and a death place, counted by the three native flags.

    The counts of ``locate_persons(..., keep_all=True)`` without a row for any combination: persons are counted by their codes,
    places by code and names. For every choice of flags, places agree on the names of that choice by equi-joins (so that names of
    few codes meet no other code, and names of many codes only the codes that persons combine), and the
    products of the counts add up to the combinations that have at least these flags; differences of these sums give the rest.
    Whatever grows with the places or the pairs of codes is merged and never broadcast: names that follow each other take a
    few bytes a row where they are stored or exchanged, but some hundred in a broadcast, which the driver builds.
    """
    # The person's own city counts where a code has no place, or a place without name.
    nameless = search.groupBy(F.col("num_insee_search").alias("_code")).agg(F.bool_or(F.col("commune_valide").isNull()).alias("_own"))
    people = persons
    for side in ("naissance", "deces"):
        own = F.coalesce("_own", F.lit(True))
        city = F.when(F.col(f"ville_{side}").isNull(), "0").otherwise(F.concat(F.lit("="), f"ville_{side}"))
        people = (
            people.join(nameless, F.col(f"num_insee_{side}") == F.col("_code"), "left")
            .withColumn(f"_city_{side}", F.when(own, city).otherwise(""))
            .drop("_own", "_code")
        )
    # Missing codes meet no place, like unknown ones.
    keys = {side: [F.coalesce(f"num_insee_{side}", F.lit("")).alias(f"code_{side}"), F.col(f"_city_{side}").alias(f"own_{side}")] for side in ("naissance", "deces")}
    counted = cut_lineage(
        people.select(*keys["naissance"], *keys["deces"])
        .groupBy("code_naissance", "own_naissance", "code_deces", "own_deces")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    choices = range(1 << len(FLAG_NAMES))

    def weights(side: str) -> DataFrame:
        """Places of every code by the names of every choice of flags; a name outside of the choice is left blank."""
        asked = counted.groupBy(F.col(f"code_{side}").alias("code"), F.col(f"own_{side}").alias("own")).agg(F.count(F.lit(1)).alias("partners"))
        own = F.when(F.col("own").startswith("="), F.expr("substring(own, 2)"))
        placed = asked.join(search.hint("merge"), F.col("code") == F.col("num_insee_search"), "left").select(
            "code", "own", "partners", F.coalesce("commune_valide", own).alias("ville"), "nom_departement", "nom_region"
        )
        named = placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("w"))

        def chosen(choice: int) -> Column:
            parts = [F.when(F.lit(bool(choice >> i & 1)), F.col(c)).otherwise("") for i, c in enumerate(FLAG_NAMES.values())]
            fields = [p.alias(f"name_{i}") for i, p in enumerate(parts)]
            return F.when(reduce(and_, [p.isNotNull() for p in parts]), F.struct(F.lit(choice).alias("choice"), *fields))

        each = F.explode(F.array_compact(F.array(*[chosen(c) for c in choices])))
        names = ["choice", *[f"name_{i}" for i in range(len(FLAG_NAMES))]]
        rows = named.select("code", "own", "partners", "w", each.alias("c")).select("code", "own", "partners", "c.*", "w")
        summed = rows.groupBy("code", "own", "partners", *names).agg(F.sum("w").alias("w"))
        return summed.withColumnsRenamed({c: f"{c}_{side}" for c in ("code", "own", "partners", "w")})

    names = ["choice", *[f"name_{i}" for i in range(len(FLAG_NAMES))]]
    born, dead = ["code_naissance", "own_naissance"], ["code_deces", "own_deces"]
    deaths = cut_lineage(weights("deces").drop("partners_deces"))
    # A name of a birth code meets either all death codes that hold the name, or all that go with the code, whichever are fewer.
    holders = deaths.groupBy(*names).agg(F.count(F.lit(1)).alias("holders"))
    births = cut_lineage(weights("naissance").join(holders.hint("merge"), names))
    # The blank name of the empty choice has all codes as holders: these go by code, not in one task.
    by_name = (F.col("holders") == 1) | (F.col("holders") < F.col("partners_naissance"))
    weight = F.col("w_naissance").cast("decimal(38,0)") * F.col("w_deces")
    product = (F.col("n") * F.col("weight")).alias("product")
    shared = births.where(by_name).join(deaths.hint("merge"), names)
    held = shared.groupBy("choice", *born, *dead).agg(F.sum(weight).alias("weight")).join(counted.hint("merge"), [*born, *dead])
    paired = births.where(~by_name).join(counted.hint("merge"), born).join(deaths.hint("merge"), [*dead, *names]).withColumn("weight", weight)
    met = held.select("choice", product).unionByName(paired.select("choice", product))
    least = met.groupBy("choice").agg(F.sum("product").alias("least"))
    # Combinations with just these flags: at least these, less those with one more, and so on.
    terms = [(flags, choice, -1 if (choice ^ flags).bit_count() % 2 else 1) for flags in choices for choice in choices if choice & flags == flags]
    table = small_table(persons.sparkSession, terms, "flags int, choice int, sign int")
    exact = least.join(F.broadcast(table), "choice").groupBy("flags").agg(F.sum(F.col("least") * F.col("sign")).cast("long").alias("nb"))
    shown = [F.when(F.expr(f"shiftright(flags, {i}) % 2 = 1"), "O").otherwise("N").alias(c) for i, c in enumerate(FLAG_NAMES)]
    return exact.where("nb > 0").select(*shown, "nb")


def with_native_flags(located: DataFrame) -> DataFrame:
    """``O`` where birth and death agree on city, department or region; a missing name gives ``N``."""
    flags = {}
    for flag, name in FLAG_NAMES.items():
        same = F.col(f"{name}_naissance") == F.col(f"{name}_deces")
        flags[flag] = F.when(same, "O").otherwise("N")
    return located.withColumns(flags)


def analysis_view(located: DataFrame) -> DataFrame:
    """Birth place names completed by the country; death country from the code (``99`` marks abroad)."""
    return (
        located.withColumn(
            "nom_departement_naissance", F.coalesce("nom_departement_naissance", "pays_naissance")
        )
        .withColumn("nom_region_naissance", F.coalesce("nom_region_naissance", "pays_naissance"))
        .withColumn(
            "pays_deces",
            F.when(F.substring("num_insee_deces", 1, 2) != "99", "FRANCE").otherwise(F.col("nom_region_deces")),
        )
    )


def home_deaths_with_excluded(
    view: DataFrame, homes: Sequence[str] = ("FRANCE", "MONACO"), home: str = "FRANCE"
) -> DataFrame:
    """Deaths in the home countries, each with the number of deaths outside ``home`` (or unknown)."""
    outside = view.agg(F.count_if((F.col("pays_deces") != home) | F.col("pays_deces").isNull())).scalar()
    return view.where(F.col("pays_deces").isin(*homes)).withColumn("nb_hors_france", outside)


def merge_all(frames: Sequence[DataFrame], keys: Sequence[str], fill: float | None = 0) -> DataFrame:
    """Full outer join of per-key tables; missing numbers become ``fill``."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.join(frame, list(keys), "full_outer")
    return result if fill is None else result.fillna(fill)
