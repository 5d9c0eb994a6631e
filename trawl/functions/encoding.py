"""Encodings of raw pages (X29): byte order mark, header, meta tag, XML prolog, guess."""

from __future__ import annotations

import codecs
import re

_BOMS = ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"), (b"\xef\xbb\xbf", "utf-8"))
_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([^\s\"';>]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*>", re.I)
_META_CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_XML = re.compile(rb'^\s*<\?xml\s+version="1\.0"\s+encoding="([^"]+)"\?>')
_COMMENT = re.compile(rb"<!--.*?-->", re.S)
#: Encodings that pages leave undeclared, with the letters that their texts are made of.
_SCRIPTS = (
    ("shift_jis", r"[\u3040-\u30ff]"),
    ("euc_jp", r"[\u3040-\u30ff]"),
    ("gb18030", r"[\u4e00-\u9fff]"),
    ("big5", r"[\u4e00-\u9fff]"),
    ("cp949", r"[\uac00-\ud7a3]"),
    ("cp1251", r"[а-яё]"),
    ("koi8_r", r"[а-яё]"),
    ("iso8859_7", r"[ά-ώ]"),
    ("cp1255", r"[א-ת]"),
    ("cp1256", r"[ء-ي]"),
    ("cp874", r"[ก-๛]"),
)
#: The most frequent characters of a language: what a wrong reading has few of.
_COMMON = {"gb18030": "的一是不了在人有我他这中大来上国个到说们为子和你地出道也时年", "big5": "的一是不了在人有我他這中大來上國個到說們為子和你地出道也時年", "cp1251": "оеаинтсрвл", "koi8_r": "оеаинтсрвл", "iso8859_7": "αοιετσνηυ", "cp1255": "יוהלאמתרשב", "cp1256": "اليمنورتبد", "cp874": "านรอกเงมยล่้วี"}
_HIGH = re.compile(rb"[\x80-\xff]+")
#: Labels that the web reads otherwise than Python does.
_LABELS = {"iso-8859-1": "cp1252", "latin1": "cp1252", "iso8859-1": "cp1252", "us-ascii": "cp1252", "ascii": "cp1252", "windows-1252": "cp1252", "tis-620": "cp874", "windows-874": "cp874", "iso-8859-11": "cp874", "iso-8859-9": "cp1254", "gb2312": "gbk", "ks_c_5601-1987": "cp949", "euc-kr": "cp949", "shift-jis": "shift_jis", "x-sjis": "shift_jis", "utf8": "utf-8", "unicode-1-1-utf-8": "utf-8"}


def codec(label: str | None) -> str | None:
    """Python's name of a charset label, None for an unknown one."""
    if not label:
        return None
    label = label.strip().lower()
    try:
        return codecs.lookup(_LABELS.get(label, label)).name
    except (LookupError, ValueError):
        return None


def of_content_type(value: str | None) -> str | None:
    found = _CHARSET.search(value or "")
    return codec(found.group(1)) if found else None


def detect(data: bytes, content_type: str | None = None) -> str | None:
    """None when nothing tells; the text is then read as UTF-8."""
    for mark, name in _BOMS:
        if data.startswith(mark):
            return name
    if name := of_content_type(content_type):
        return name
    for tag in _META.findall(_COMMENT.sub(b"", data)):
        found = _META_CHARSET.search(tag.decode("ascii", "ignore"))
        if found and (name := codec(found.group(1))):
            return "utf-8" if name.startswith("utf-16") else name
    if (found := _XML.match(data)) and (name := codec(found.group(1).decode("ascii", "ignore"))):
        return name
    try:
        data.decode("utf-8")
        return None
    except UnicodeDecodeError:
        return guess(data)


def guess(data: bytes) -> str:
    """The encoding whose script most of the high bytes are letters of; Western European when none is clear.

    A reading counts by the share of its characters that are of its script, and where
    other encodings read the same bytes as letters, by the share of frequent ones.
    Letters with marks among plain ones, as Western languages have, stand alone.
    """
    runs = _HIGH.findall(data)
    high = b" ".join(runs)
    if len(high) < 2.5 * len(runs):
        return "cp1252"
    # Two bytes may be a high and a low one, so those are tried on the whole text.
    best, name = 0.5, "cp1252"
    for encoding, letters in _SCRIPTS:
        try:
            text = (data if encoding in ("shift_jis", "gb18030", "big5", "cp949") else high).decode(encoding)
        except UnicodeDecodeError:
            continue
        foreign = [ch for ch in text if ch > "\x7f"]
        if not foreign:
            continue
        share = len(re.findall(letters, "".join(foreign))) / len(foreign)
        if encoding in _COMMON and share > 0.5:
            share = 0.5 + sum(ch in _COMMON[encoding] for ch in foreign) / len(foreign)
        if share > best:
            best, name = share, encoding
    return name


def decode(data: bytes, content_type: str | None = None) -> str:
    """The text, with what can't be read left out."""
    return data.decode(detect(data, content_type) or "utf-8", "ignore").lstrip("﻿")
