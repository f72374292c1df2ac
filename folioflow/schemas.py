"""Schemas of the flow, as Spark DDL."""

BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
ELEMENT = f"struct<label: string, bbox: {BOX}, content: string>"
RESULT = f"markdown string, elements array<{ELEMENT}>, raw string"
PAGE_IMAGE = "doc_id string, modified timestamp, page int, image binary, scale double, width int, height int"
WORD = "doc_id string, page int, width double, height double, x0 double, y0 double, x1 double, y1 double, word string"
QUESTION = "struct<id: string, marks: int, text: string, diagrams: array<string>, page: int, answer: string, working: string, notes: string>"
DATASET = f"paper string, subject string, series string, kind string, source_pdf string, pages int, questions array<{QUESTION}>, latex_repairs array<string>"
CACHE = f"key string, {RESULT}"
