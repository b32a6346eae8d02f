"""Labels, edge types and the schemas (DDL) of JSON inputs."""

from __future__ import annotations



# Fixed values of the data model.
NODE_LABELS = ("Talk", "Event", "Group", "Speaker", "Company", "Project")
EDGE_TYPES = ("PRESENTED_AT", "PART_OF", "PRESENTED_BY", "WORKS_AT", "MENTIONS")
#: Labels of the nodes that each edge type joins.
ENDPOINTS = {
    "PRESENTED_AT": ("Talk", "Event"),
    "PART_OF": ("Event", "Group"),
    "PRESENTED_BY": ("Talk", "Speaker"),
    "WORKS_AT": ("Speaker", "Company"),
    "MENTIONS": ("Talk", "Project"),
}
HEURISTIC_VERSION, MODEL_VERSION = "1.0", "1.1"

NODES = ("id string, label string, props string")
EDGES = ("src string, dst string, label string, props string")

#: Both serialisations of a talk record: label/props and the older type/properties. Bags stay JSON text.
RECORD = (
    "schema_version string, id string, scraped_at string, source_file string, "
    "nodes array<struct<id: string, label: string, type: string, props: string, properties: string>>, "
    "edges array<struct<`from`: string, `to`: string, label: string, type: string, props: string, properties: string>>"
)

#: A talk record as operators.records builds it.
STORED_RECORD = (
    "schema_version string, id string, scraped_at string, source_file string, "
    "nodes array<struct<id: string, label: string, props: string>>, edges array<struct<src: string, dst: string, label: string, props: string>>"
)

EVENT_NODE = "struct<id: string, title: string, dateTime: string, description: string, eventUrl: string, venue: struct<name: string, address: string, city: string, state: string>>"
#: A page of a group's events. Nodes stay JSON text, so that one bad node does not void its page.
EVENT_PAGE = ("data struct<groupByUrlname: struct<events: struct<edges: array<struct<node: string>>>>>, errors string")

SPEAKERS = "array<struct<name: string, company: string, role: string, bio: string>>"
TALKS = (f"array<struct<title: string, abstract: string, speakers: {SPEAKERS}, `order`: int>>")

ANSWER = (
    "content array<struct<type: string, input: struct<events: array<struct<event_id: string, talks: array<struct<"
    "title: string, abstract: string, abstract_text: string, "
    "speakers: array<struct<name: string, role: string, company: string, bio: string>>, projects: array<struct<name: string>>>>>>>>>"
)

#: Crawl records: events, speakers and talks in one schema.
CRAWL_SOURCE = (
    "source_id string, source_url string, source_file string, extracted_file string, "
    "event struct<id: string, title: string, dateTime: string, endTime: string, description: string, eventType: string, "
    "eventUrl: string, isOnline: boolean, status: string, `group`: struct<id: string, name: string, timezone: string>>, "
    "meetup_id string, meetup_name string, meetup_url string, name string, role string, talk_title string, talk_url string, "
    "title string, speaker_text string, tags array<string>, url string, conference_id string"
)
