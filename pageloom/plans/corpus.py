"""Encyclopedia pages derived from the relational tables.

Every row of every table becomes one page whose markup links to the pages of the
rows it refers to. A page needs nothing but its own row, so the corpus is a plain
projection: it grows with the tables, takes no shuffle, and what the import must
find in it can be computed from the same rows without reading any markup.

Titles need not be unique: rows of `lineitem` that share order and line number
give several pages of one title, and those of open lines carry outer white space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import xml_escape

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores: conversion is CPU work, and a file with one row group is one
    task however many cores wait. With enough input partitions this does nothing."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fill(template: str, **columns: Column) -> Column:
    """`{name}` in the template is replaced by a column; the rest is text."""
    parts: list[Column] = []
    for piece in template.replace("{", "\0{").replace("}", "}\0").split("\0"):
        if piece.startswith("{"):
            parts.append(columns[piece[1:-1]].cast("string"))
        elif piece:
            parts.append(F.lit(piece.replace("⟦", "{{").replace("⟧", "}}").replace("⦃", "{").replace("⦄", "}")))
    return F.concat(*parts)


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


NO_TIME = "no time"
FIXED_TIME = "2014-01-02T03:04:05Z"

# Templates per style. ⟦ ⟧ stand for double braces, ⦃ ⦄ for single ones.
LOT = {
    "list": (
        "Part of [[Order {o}]].\n== Goods ==\n* [[Part {p}#lot|lot]] from [[Supplier {s}]]\n"
        "=== Terms ===\nReturned ''{r}'' on [[Order {o}]]."
    ),
    # the same page with markup around it that must leave no trace
    "noise": (
        "⟦box|k=⟦inner|{o}|⟦deep|⟦deeper|[[Hidden {p}]]⟧⟧⟧⟧Part<!-- [[Ghost {p}]] --> of "
        "[[Order {o}]].<ref name=\"a\">see [[Cited {s}]]</ref>\n== Goods ==\n__TOC__"
        "* [[Part {p}#lot|'''lot''']] <small>from</small> [[Supplier {s}]]<ref name=b />"
        "[[File:lot.jpg|thumb|a [[Caption {p}]] here]]\n=== Terms ===\n"
        "Returned ''{r}'' ⟦⦃1⦄⟧on <nowiki>[[Not {o}]]</nowiki>[[Order {o}]].[[Category:Lots]]"
    ),
    "table": (
        "⦃| class=\"wikitable\"\n|+ Order {o}\n! Part !! style=\"w\" | Supplier\n|-\n"
        "| [[Part {p}#lot|lot]] || style=\"x\" | [[Supplier {s}]]\n|- class=\"r\"\n"
        "| {r}\n| || [[Order {o}]]\n|⦄\nShipped || done."
    ),
    "sections": (
        "== A ==\n=== B {p} ===\n=== C ===\n== [[Order {o}]] ==\n==== E ====\n=== F ===\n"
        "=== G ===\n= H =\n== {r} =="
    ),
    "entities": (
        "Order&nbsp;{o} &ndash; &#80;art&#x20;{p} &lt;b&gt; &unknown; AT&T<BR/>"
        "<span class=\"x\">R&amp;D</span> &#128512; [[Supplier {s}|S&eacute;ller&nbsp;{s}]]&#1;"
    ),
}


def pages_of(
    spark: SparkSession, sf_dir: str, table: str, style: str = "list", rows: DataFrame | None = None
) -> DataFrame:
    """(title, timestamp, wikitext, file) for each row of one table."""
    df = rows if rows is not None else read_table(spark, sf_dir, table)
    if rows is None and table not in ("region", "nation"):
        df = spread(df)
    col = F.col
    if table == "region":
        out = df.select(
            fill("Region {k}", k=col("r_regionkey")).alias("title"),
            F.lit(None).cast("string").alias("timestamp"),
            fill(
                "'''{n}''' is a region. [[Category:Regions]]", n=col("r_name")
            ).alias("wikitext"),
        )
    elif table == "nation":
        keys = dict(k=col("n_nationkey"), n=col("n_name"), r=col("n_regionkey"))
        entry = F.struct(
            fill("Nation {k}", **keys).alias("title"),
            F.lit(NO_TIME).alias("timestamp"),
            fill("'''{n}''' lies in [[Region {r}|the region]].", **keys).alias("wikitext"),
        )
        redirect = F.struct(
            col("n_name").alias("title"),
            F.lit(FIXED_TIME).alias("timestamp"),
            fill("#REDIRECT [[Nation {k}#Top|{n}]]", **keys).alias("wikitext"),
        )
        out = df.select(F.inline(F.array(entry, redirect)))
    elif table == "customer":
        keys = dict(
            k=col("c_custkey"), n=col("c_name"), m=col("c_mktsegment"), a=col("c_nationkey")
        )
        out = df.select(
            fill("Customer {k}", **keys).alias("title"),
            F.lit(FIXED_TIME).alias("timestamp"),
            fill("⟦infobox|seg={m}⟧{n} of [[Nation {a}]].", **keys).alias("wikitext"),
        )
    elif table == "supplier":
        keys = dict(k=col("s_suppkey"), n=col("s_name"), a=col("s_nationkey"))
        entry = F.struct(
            fill("Supplier {k}", **keys).alias("title"),
            F.lit(FIXED_TIME).alias("timestamp"),
            fill(
                "{n} of [[Nation {a}#Suppliers|nation]]s, see [http://s.example/{k} site]"
                " and [http://s.example/{k}/more].",
                **keys,
            ).alias("wikitext"),
        )
        # Two suppliers share a depot: only the digest tells which of its pages stands.
        shared = fill("Depot {d}", d=F.expr("s_suppkey div 2"))
        depot = F.struct(
            F.when(col("s_suppkey") % 2 == 1, F.concat(F.lit(" "), shared)).otherwise(shared).alias("title"),
            F.lit(FIXED_TIME).alias("timestamp"),
            fill("Used by [[Supplier {k}]].", **keys).alias("wikitext"),
        )
        out = df.select(F.inline(F.array(entry, depot)))
    elif table == "part":
        keys = dict(k=col("p_partkey"), n=col("p_name"), b=col("p_brand"), t=col("p_type"))
        out = df.select(
            fill("Part {k}", **keys).alias("title"),
            F.lit(FIXED_TIME).alias("timestamp"),
            fill("''{n}'' by [[{b}]]<!-- {t} --> [[Category:{t}]]", **keys).alias("wikitext"),
        )
    elif table == "orders":
        keys = dict(
            k=col("o_orderkey"), c=col("o_custkey"), p=col("o_orderpriority"), s=col("o_orderstatus")
        )
        out = df.select(
            fill("Order {k}", **keys).alias("title"),
            _iso("o_orderdate").alias("timestamp"),
            fill(
                "By [[Customer {c}]].\n* priority {p}\n* [[ Status {s} ]]", **keys
            ).alias("wikitext"),
        )
    elif table == "lineitem":
        keys = dict(
            o=col("l_orderkey"),
            n=col("l_linenumber"),
            p=col("l_partkey"),
            s=col("l_suppkey"),
            r=col("l_returnflag"),
        )
        title = fill("Lot {o}/{n}", **keys)
        spaced = F.concat(F.lit(" \t"), title, F.lit("\n"))
        out = df.select(
            F.when(col("l_linestatus") == "O", spaced).otherwise(title).alias("title"),
            _iso("l_shipdate").alias("timestamp"),
            fill(LOT[style], **keys).alias("wikitext"),
        )
    else:
        raise ValueError(f"no pages are made of table {table}")
    return out.withColumn("file", F.lit(f"{table}.xml"))


def corpus(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """The pages of all the tables named."""
    return reduce(DataFrame.unionByName, [pages_of(spark, sf_dir, t) for t in tables])


def page_xml(pages: DataFrame) -> DataFrame:
    """Write pages as dump XML, as the readers would deliver them.

    A timestamp of null leaves the element out.
    """
    stamp = F.when(
        F.col("timestamp").isNotNull(),
        F.concat(F.lit("      <timestamp>"), F.col("timestamp"), F.lit("</timestamp>\n")),
    ).otherwise(F.lit(""))
    raw = F.concat(
        F.lit("<page>\n    <title>"),
        xml_escape(F.col("title")),
        F.lit("</title>\n    <ns>0</ns>\n    <revision>\n"),
        stamp,
        F.lit('      <text xml:space="preserve">'),
        xml_escape(F.col("wikitext")),
        F.lit("</text>\n    </revision>\n  </page>"),
    )
    return pages.select(
        raw.alias("raw"),
        "file",
        F.col("file").alias("file_path"),
        F.lit(0).cast("long").alias("file_block_start"),
    )


def raw_corpus(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = TABLES) -> DataFrame:
    return page_xml(corpus(spark, sf_dir, tables))


def faulty_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and parts, some of them damaged by what their rows say.

    Orders of status P hold a bare `&`; parts larger than 40 have a title with
    brackets; parts of size 1 redirect to nothing.
    """
    orders = page_xml(pages_of(spark, sf_dir, "orders")).withColumn(
        "raw",
        F.when(
            F.contains("raw", F.lit("Status P")),
            F.replace("raw", F.lit("By "), F.lit("By R&D ")),
        ).otherwise(F.col("raw")),
    )
    part = spread(read_table(spark, sf_dir, "part"))
    size = F.col("p_size")
    title = fill("Part {k}", k=F.col("p_partkey"))
    parts = part.select(
        F.when(size > 40, F.concat(title, F.lit(" [big]"))).otherwise(title).alias("title"),
        F.lit(FIXED_TIME).alias("timestamp"),
        F.when(size == 1, F.lit("#REDIRECT [[]]")).otherwise(
            fill("by [[{b}]]", b=F.col("p_brand"))
        ).alias("wikitext"),
        F.lit("part.xml").alias("file"),
    )
    return orders.unionByName(page_xml(parts))


def colliding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pages per customer whose links get the same edge id."""
    df = spread(read_table(spark, sf_dir, "customer"))
    keys = dict(k=F.col("c_custkey"), a=F.col("c_nationkey"))
    longer = F.struct(
        fill("Acct {k}_N{a}", **keys).alias("title"), F.lit("to [[Hub]]").alias("wikitext")
    )
    shorter = F.struct(
        fill("Acct {k}", **keys).alias("title"), fill("to [[N{a}_Hub]]", **keys).alias("wikitext")
    )
    return df.select(F.inline(F.array(longer, shorter))).select(
        "title",
        F.lit(FIXED_TIME).alias("timestamp"),
        "wikitext",
        F.lit("customer.xml").alias("file"),
    )


def redirect_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A redirect and an article per customer. Redirects lead to the one before, up to 15 of
    them to a customer; of 64 the last 16 lead in a circle."""
    k = F.col("c_custkey")
    ring = fill("Route {k}", k=F.when(k % 64 == 63, k - 15).otherwise(k + 1))
    back = F.when(k % 16 == 0, fill("Customer {k}", k=k)).otherwise(fill("Route {k}", k=k - 1))
    route = F.struct(
        fill("Route {k}", k=k).alias("title"),
        F.concat(F.lit("#REDIRECT [["), F.when(k % 64 >= 48, ring).otherwise(back), F.lit("]]")).alias("wikitext"),
    )
    article = F.struct(
        fill("Stop {k}", k=k).alias("title"), fill("On [[Route {k}]] in [[Nation {n}]].", k=k, n=F.col("c_nationkey")).alias("wikitext")
    )
    return spread(read_table(spark, sf_dir, "customer")).select(F.inline(F.array(route, article))).select(
        "title", F.lit(FIXED_TIME).alias("timestamp"), "wikitext", F.lit("customer.xml").alias("file")
    )


def nested_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots with templates and parameters as deep as their quantity says, and braces that
    nothing closes or opens."""
    lots = spread(read_table(spark, sf_dir, "lineitem"))
    depth = F.col("l_quantity").cast("int")
    keys = dict(o=F.col("l_orderkey"), p=F.col("l_partkey"), s=F.col("l_suppkey"))
    templates = F.concat(F.repeat(F.lit("{{n|k="), depth), fill("[[Hidden {p}]]", **keys), F.repeat(F.lit(" }}"), depth))
    parameters = F.concat(F.repeat(F.lit("{{{v|"), depth), F.lit("{{t|{x} }}"), F.repeat(F.lit("}}}"), depth))
    pages = lots.select(
        fill("Lot {o}/{n}", o=F.col("l_orderkey"), n=F.col("l_linenumber")).alias("title"),
        F.lit(FIXED_TIME).alias("timestamp"),
        F.concat(
            F.lit("Part"), templates, fill(" of [[Order {o}]]", **keys), parameters, F.lit(" }} from {{a"), templates,
            fill(" [[Supplier {s}]] {1}", **{"1": F.lit("{1}")}, **keys), parameters, F.lit("."),
        ).alias("wikitext"),
        F.lit("lineitem.xml").alias("file"),
    )
    return pages


def residue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as definition lists, with braces and brackets that nothing closes or opens."""
    keys = dict(k=F.col("o_orderkey"), c=F.col("o_custkey"), s=F.col("o_orderstatus"))
    text = fill("; Order {k}\n: by [[Customer {c}]] ⟧ x; y: z\n: [[ {s}\n;]]", **keys)
    return spread(read_table(spark, sf_dir, "orders")).select(
        fill("Order {k}", **keys).alias("title"), F.lit(FIXED_TIME).alias("timestamp"), text.alias("wikitext"), F.lit("orders.xml").alias("file")
    )


# Pages of a part whose markup the other pages lack: title and wikitext.
RARE = {
    "Bare": "See http://p.example/{k} now, {n}.",
    "Rule": "a {n}\n\nb\n----\nc",
    "Steps": "# one [[Part {k}]]\n# two\n## three",
    "Only": "⟦only|{k}⟧",
    "Moved": "#REDIRECT [[Part {k}]] see [[{b}]] and [[Part {k}#x|it]]",
    "Twice": "first [[Part {k}]]",
}
SECOND_REVISION = "<revision><text> and [[second]]</text></revision>"


def rare_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages of `RARE`; those titled Twice have a second revision."""
    keys = dict(k=F.col("p_partkey"), n=F.col("p_name"), b=F.col("p_brand"))
    entries = [F.struct(fill(name + " {k}", **keys).alias("title"), fill(text, **keys).alias("wikitext")) for name, text in RARE.items()]
    pages = spread(read_table(spark, sf_dir, "part")).select(F.inline(F.array(*entries)))
    raw = page_xml(pages.withColumns({"timestamp": F.lit(FIXED_TIME), "file": F.lit("part.xml")}))
    end = F.lit("</revision>")
    twice = F.replace("raw", end, F.concat(end, F.lit(SECOND_REVISION)))
    return raw.withColumn("raw", F.when(F.contains("raw", F.lit("<title>Twice")), twice).otherwise(F.col("raw")))


def ontology_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ontology document, line by line (n, value): a class per region, and a property per
    nation, which leads from pages to its region. Names stand behind a declared entity."""
    head = [
        '<?xml version="1.0"?>', "<!DOCTYPE rdf:RDF [", '  <!ENTITY here "http://world.example/" >', "]>",
        '<rdf:RDF xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:x="http://x.example/#">',
        '  <!-- <owl:Class rdf:about="&here;hidden"/> -->',
    ]
    region, nation = (read_table(spark, sf_dir, t) for t in ("region", "nation"))
    classes = region.select(
        (F.col("r_regionkey") + 100).cast("long").alias("n"),
        fill(
            '  <owl:Class rdf:about="&here;region{k}"><rdfs:label xml:lang="en">{n}</rdfs:label>'
            '<x:displayType xml:lang="en">place</x:displayType></owl:Class>',
            k=F.col("r_regionkey"), n=F.col("r_name"),
        ).alias("value"),
    )
    properties = nation.select(
        (F.col("n_nationkey") + 100_000).cast("long").alias("n"),
        fill(
            '  <owl:ObjectProperty rdf:about="&here;in{k}"><rdfs:label xml:lang="en">in {n}</rdfs:label>'
            '<rdfs:domain rdf:resource="&here;page"/><rdfs:range rdf:resource="&here;region{r}"/></owl:ObjectProperty>',
            k=F.col("n_nationkey"), n=F.col("n_name"), r=F.col("n_regionkey"),
        ).alias("value"),
    )
    frame = spark.createDataFrame([*enumerate(head), (10**12, "</rdf:RDF>")], "n long, value string")
    return frame.unionByName(classes).unionByName(properties)
