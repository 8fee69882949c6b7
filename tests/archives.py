"""Builders of small exam archives for tests (DOCX tables, XDEX XML/JSON)."""

import json
import zipfile

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _cell(text):
    if isinstance(text, (list, tuple)):  # split runs
        runs = "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in text)
    else:
        runs = f"<w:r><w:t>{text}</w:t></w:r>" if text != "" else ""
    return f"<w:tc><w:p>{runs}</w:p></w:tc>"


def docx(path, tables):
    body = ""
    for rows in tables:
        body += "<w:tbl>" + "".join("<w:tr>" + "".join(_cell(c) for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"
    xml = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", xml)


def xdex_xml(path, xml):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("data/export.xml", xml)


def xdex_json(path, test, document=None, encoding="utf-8"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("t1/test.json", json.dumps(test, ensure_ascii=False).encode(encoding))
        z.writestr("t1/document.json", json.dumps(document or {"channelInfos": {}}, ensure_ascii=False))


def score(auto=None, manual=None, changed=False, value=None, points=None):
    d = {"isManuallyChanged": changed}
    if manual is not None:
        d["manualValue"] = manual
    if auto is not None:
        d["autoValue"] = auto
    if value is not None:
        d["value"] = value
    if points is not None:
        d["automaticScorePoints"] = [{"value": p} for p in points]
    return d
