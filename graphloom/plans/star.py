"""The property graph that the star-schema tables stand for.

orders are talks, customers events, nations groups, suppliers speakers, a
supplier's nation is its company, parts are projects. A talk's lines give its
speakers and projects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.graph import distinct_edges


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nid(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


def _node(label: str, id_: Column, **props: Column) -> Column:
    bag = F.to_json(F.struct(*[c.alias(n) for n, c in props.items()]))
    return F.struct(id_.alias("id"), F.lit(label).alias("label"), bag.alias("props"))


def _edge(label: str, src: Column, dst: Column) -> Column:
    return F.struct(src.alias("src"), dst.alias("dst"), F.lit(label).alias("label"))


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with all that they refer to."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    nations, parts = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part")
    # orders meet their customers before lines meet them: no wide row of a line is exchanged for a customer
    told = (
        orders.select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customers.select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("group_name")), "c_nationkey")
    )
    makers = suppliers.select("s_suppkey", "s_name", "s_nationkey").join(nations.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("company_name")), "s_nationkey")
    return (
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
        .join(parts.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .join(makers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(told, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _ids() -> dict[str, Column]:
    """Ids of a line's nodes by label."""
    return {
        "Talk": nid("talk", "l_orderkey"), "Event": nid("event", "o_custkey"), "Group": nid("group", "c_nationkey"),
        "Speaker": nid("speaker", "l_suppkey"), "Company": nid("company", "s_nationkey"), "Project": nid("project", "l_partkey"),
    }


def _line_edges(ids: dict[str, Column]) -> list[Column]:
    return [_edge(t, ids[a], ids[b]) for t, (a, b) in schemas.ENDPOINTS.items()]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line of an order, as crawled: event and group are repeated in each.

    Columns: source_file (order and line, sortable), nodes, edges.
    """
    rows, ids = _joined_lines(spark, sf_dir), _ids()
    place = F.format_string("%012d-%04d-%09d-%09d", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")  # line numbers repeat
    nodes = F.array(
        _node("Talk", ids["Talk"], title=F.col("p_name"), order=F.col("l_linenumber")),
        _node("Event", ids["Event"], id=F.col("o_custkey").cast("string"), title=F.col("c_name"), date=F.date_format("o_orderdate", "yyyy-MM-dd")),
        _node("Group", ids["Group"], slug=F.col("c_nationkey").cast("string"), name=F.col("group_name")),
        _node("Speaker", ids["Speaker"], name=F.col("s_name"), company=F.col("company_name")),
        _node("Company", ids["Company"], name=F.col("company_name")),
        _node("Project", ids["Project"], name=F.col("p_name")),
    )
    return rows.select(place.alias("source_file"), nodes.alias("nodes"), F.array(*_line_edges(ids)).alias("edges"))


def raw_things(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, label) of the records' nodes, which have no src, and edges, repeated as in the records, from one reading."""
    ids = _ids()
    nodes = [_edge(label, F.lit(None).cast("string"), i) for label, i in ids.items()]
    return _joined_lines(spark, sf_dir).select(F.inline(F.array(*nodes, *_line_edges(ids))))


def raw_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_file, pos, id, label, props), nodes repeated as in the records."""
    return records(spark, sf_dir).select("source_file", F.posexplode("nodes").alias("pos", "n")).select("source_file", "pos", "n.*")


def raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, label), edges repeated as in the records."""
    return records(spark, sf_dir).select(F.explode("edges").alias("e")).select("e.*")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct edges, from the tables themselves: orders without lines are talks without speakers."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")

    def of(rows: DataFrame, label: str, src: Column, dst: Column) -> DataFrame:
        return rows.select(src.alias("src"), dst.alias("dst"), F.lit(label).alias("label"))

    parts = (
        of(orders, "PRESENTED_AT", nid("talk", "o_orderkey"), nid("event", "o_custkey")),
        of(customers, "PART_OF", nid("event", "c_custkey"), nid("group", "c_nationkey")),
        of(lines, "PRESENTED_BY", nid("talk", "l_orderkey"), nid("speaker", "l_suppkey")),
        of(suppliers, "WORKS_AT", nid("speaker", "s_suppkey"), nid("company", "s_nationkey")),
        of(lines, "MENTIONS", nid("talk", "l_orderkey"), nid("project", "l_partkey")),
    )
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return distinct_edges(whole)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, props) from the tables themselves."""
    name = lambda c: F.to_json(F.struct(F.col(c).alias("name")))
    nations = table(spark, sf_dir, "nation")
    parts = (
        table(spark, sf_dir, "orders").select(nid("talk", "o_orderkey").alias("id"), F.lit("Talk").alias("label"), F.lit("{}").alias("props")),
        table(spark, sf_dir, "customer").select(nid("event", "c_custkey").alias("id"), F.lit("Event").alias("label"), name("c_name").alias("props")),
        nations.select(nid("group", "n_nationkey").alias("id"), F.lit("Group").alias("label"), name("n_name").alias("props")),
        table(spark, sf_dir, "supplier").select(nid("speaker", "s_suppkey").alias("id"), F.lit("Speaker").alias("label"), name("s_name").alias("props")),
        nations.select(nid("company", "n_nationkey").alias("id"), F.lit("Company").alias("label"), name("n_name").alias("props")),
        table(spark, sf_dir, "part").select(nid("project", "p_partkey").alias("id"), F.lit("Project").alias("label"), name("p_name").alias("props")),
    )
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def _spelled(key: str | Column) -> Column:
    """A number in letters."""
    return F.translate((F.col(key) if isinstance(key, str) else key).cast("string"), "0123456789", "abcdefghij")


def person(key: str, first: str = "Ann") -> Column:
    """A name made of a key."""
    return F.concat(F.lit(f"{first} "), F.initcap(_spelled(key)), F.lit("son"))


def company(key: str) -> Column:
    """A company made of a key."""
    return F.concat(F.initcap(_spelled(key)), F.lit("corp"))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as talks: l_orderkey, l_linenumber, l_partkey, l_suppkey, person, company, title."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.initcap("p_name").alias("thing"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    title = F.concat(F.lit("Shipping "), F.col("thing"), F.lit(" By Lot "), F.initcap(_spelled("l_linenumber")))
    told = lines.join(parts, "l_partkey").join(suppliers, "l_suppkey")
    return told.withColumns({"person": person("l_suppkey"), "company": company("s_nationkey"), "title": title})


def five_layouts() -> Column:
    """A lot's text in a layout by order: bold title, numbered section, labels, bullet with a long dash, time slot."""
    layout = F.col("l_orderkey") % 5
    return (
        F.when(layout == 0, F.format_string("**%s**\n\n*%s, %s*\nA talk on lots.\n", "title", "person", "company"))
        .when(layout == 1, F.format_string("(%d) %s\n%s, %s\n", "l_linenumber", "title", "person", "company"))
        .when(layout == 2, F.format_string("Presentation: %s\nSpeaker: %s, %s\n", "title", "person", "company"))
        .when(layout == 3, F.format_string("* %s – %s, %s\n", "title", "person", "company"))
        .otherwise(F.format_string("6:30 - %s - %s, %s\n", "title", "person", "company"))
    )


def other_layouts() -> Column:
    """A lot's text in a layout by order: heading and label, quotes twice, bulleted agenda twice."""
    layout, even = F.col("l_orderkey") % 5, F.col("l_linenumber") % 2 == 0
    return (
        F.when(layout == 0, F.format_string("## %s\nSpeaker: %s, %s\nWords on lots.\n", "title", "person", "company"))
        .when(layout == 1, F.format_string('"%s" by %s, %s.\n\n* more\n', "title", "person", "company"))
        .when(layout == 2, F.format_string('"%s"\n%s, %s\nWords on lots.\n\n* more\n', "title", "person", "company"))
        .when((layout == 3) & even, F.format_string("* **%s** - %s, %s\n", "title", "person", "company"))
        .when(layout == 3, F.format_string("* %s - %s, %s\n", "title", "person", "company"))
        .otherwise(F.format_string("* **%s**\n%s, %s\n", "title", "person", "company"))
    )


def labels_layout() -> Column:
    """A lot's text with labels, whatever the order."""
    return F.format_string("Presentation: %s\nSpeaker: %s, %s\n", "title", "person", "company")


def described_orders(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    """Orders with o_orderkey, o_custkey, o_orderdate, c_nationkey and `description`: their lots' texts in order; null without lots."""
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", text.alias("text"))
    blocks = lots(spark, sf_dir).select("l_orderkey", place.alias("b"))
    whole = blocks.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list("b"))["text"], "\n").alias("description"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # keys meet first, so that descriptions are not exchanged for the customers
    return orders.join(customers, "o_custkey").join(whole, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def announcements(spark: SparkSession, sf_dir: str, text: Column | None = None) -> DataFrame:
    """Event nodes (struct `node`, `group_slug`) made of orders, customers and suppliers.

    Each line of an order is a talk of its description; titles, people and companies
    are spelled from the tables' keys and names.
    """
    told = described_orders(spark, sf_dir, five_layouts() if text is None else text)
    key = F.col("o_orderkey").cast("string")
    node = F.struct(
        key.alias("id"),
        F.concat(F.lit("Evening "), key).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'20:00:00-08:00").alias("dateTime"),
        "description",
        F.concat(F.lit("https://example.org/events/"), key, F.lit("/")).alias("eventUrl"),
        F.struct(*[F.lit(None).cast("string").alias(n) for n in ("name", "address", "city", "state")]).alias("venue"),
    )
    return told.select(node.alias("node"), F.concat(F.lit("group-"), F.col("c_nationkey").cast("string")).alias("group_slug"))


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event pages (key, html, url, group_slug, event_id) made of orders.

    By order, in turn: a page state, a JSON-LD script, a plain page with a marked
    description, one with a description class. A state names its venue by reference
    (every eighth order) or holds it. Orders without lots tell their talk in the title.
    """
    told = described_orders(spark, sf_dir, labels_layout())
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    nation = F.col("c_nationkey").cast("string")
    own_title = F.concat(person("o_custkey"), F.lit(": Shipping Goods By Lot "), F.initcap(_spelled("o_orderkey")))
    title = F.when(F.col("description").isNull(), own_title).otherwise(F.concat(F.lit("Evening "), key))
    date = F.date_format("o_orderdate", "yyyy-MM-dd'T'20:00:00-08:00")
    url = F.concat(F.lit("https://example.org/events/"), key, F.lit("/"))
    none = F.lit(None).cast("string")
    place = lambda hall: [hall.alias("name"), F.when(hall.isNotNull(), F.lit("1 Road")).alias("address"), F.when(hall.isNotNull(), F.lit("Town")).alias("city")]
    hall = F.concat(F.lit("Hall "), key)
    by_name = F.col("o_orderkey") % 8 == 0
    venue = F.struct(F.when(by_name, F.lit("Venue:1")).alias("__ref"), *place(F.when(~by_name, hall)))
    entry = lambda **c: F.struct(*[c.get(n, none).alias(n) for n in ("id", "title", "description", "dateTime", "eventUrl")],
        c.get("venue", F.lit(None).cast("struct<__ref:string,name:string,address:string,city:string>")).alias("venue"),
        c.get("group", F.lit(None).cast("struct<__ref:string>")).alias("group"), *c.get("place", place(none)))
    group = F.struct(F.concat(F.lit("Group:"), nation).alias("__ref"))
    state = F.create_map(
        F.concat(F.lit("Event:"), key), entry(id=key, title=title, description=F.col("description"), dateTime=date, eventUrl=url, venue=venue, group=group),
        F.lit("Venue:1"), entry(place=place(hall)),
        F.concat(F.lit("Group:"), nation), entry(place=[F.concat(F.lit("Group "), nation).alias("name"), none.alias("address"), none.alias("city")]),
    )
    address = F.struct(F.lit("2 Road").alias("streetAddress"), F.lit("City").alias("addressLocality"))
    script = F.struct(
        F.lit("Event").alias("@type"), title.alias("name"), F.col("description"), date.alias("startDate"),
        F.struct(F.concat(F.lit("Room "), key).alias("name"), address.alias("address")).alias("location"),
        F.struct(F.concat(F.lit("Makers "), nation).alias("name")).alias("organizer"),
    )
    body = F.coalesce("description", F.lit(""))
    html = (
        F.when(kind == 0, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"__APOLLO_STATE__":'), F.to_json(state), F.lit("}}}</script><h1>No</h1>")))
        .when(kind == 1, F.concat(F.lit('<script type="application/ld+json">{"@type":"Place"}</script><script type="application/ld+json">'), F.to_json(script), F.lit("</script><h1>No</h1>")))
        .when(kind == 2, F.concat(F.lit("<body><h1> "), title, F.lit('</h1><div class="event-description">no</div><div data-testid="event-description">'), body, F.lit("</div></body>")))
        .otherwise(F.concat(F.lit("<body><h1>"), title, F.lit('</h1><h1>No</h1><div class="x event-description">'), body, F.lit("</div></body>")))
    )
    return told.select(F.col("o_orderkey").alias("key"), html.alias("html"), url.alias("url"), F.concat(F.lit("group-"), nation).alias("group_slug"), key.alias("event_id"))


def filled_lines(spark: SparkSession, sf_dir: str, templates: tuple[str, ...]) -> DataFrame:
    """(key, form, line) of customers: templates in turn, with {n} and {m} for names, {c} for a company, {t} for a title."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey")
    form = F.pmod(F.col("key"), F.lit(len(templates))).cast("int")
    line = F.element_at(F.array(*map(F.lit, templates)), form + 1)
    values = {"{n}": person("key"), "{m}": person("key", "Bob"), "{c}": company("c_nationkey"), "{t}": F.concat(F.lit("Shipping Goods By Lot "), F.initcap(_spelled("key")))}
    for mark, value in values.items():
        line = F.replace(line, F.lit(mark), value)
    return rows.select("key", form.alias("form"), line.alias("line"))
