"""Small dump files, built in memory."""

from __future__ import annotations

import gzip
import lzma
import struct
import zlib

HEAD = '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/" version="0.11"><siteinfo><namespaces><namespace key="0" case="first-letter" /><namespace key="3" case="first-letter">User talk</namespace></namespaces></siteinfo>'


def revision(rid, stamp, who, text, extra="", parent=None):
    par = f"<parentid>{parent}</parentid>" if parent else ""
    return f"<revision><id>{rid}</id>{par}<timestamp>{stamp}</timestamp>{who}{extra}<model>wikitext</model>{text}<sha1>s{rid}</sha1></revision>"


def user(name, uid):
    return f"<contributor><username>{name}</username><id>{uid}</id></contributor>"


def history_xml(a=10, b=11, c=12) -> str:
    revs = [
        revision(a, "2020-01-01T00:00:00Z", user("Imke", 310), '<text bytes="17" xml:space="preserve">moss grows slowly</text>'),
        revision(b, "2020-01-02T00:00:00Z", user("Tjark", 311), '<text bytes="0" deleted="deleted" />'),
        revision(c, "2020-01-03T00:00:00Z", user("Yara", 312), '<text bytes="15" xml:space="preserve">rain fell early</text>'),
    ]
    return f"{HEAD}<page><title>A page</title><ns>0</ns><id>7</id>{''.join(revs)}</page></mediawiki>"


def stub_xml() -> str:
    text = '<text bytes="5" />'
    revs = [
        revision(1, "2020-01-01T00:00:00Z", user("Imke", 310), text),
        revision(2, "2020-01-02T00:00:00Z", "<contributor><ip>127.0.0.1</ip></contributor>", text, "<minor />", parent=1),
        revision(3, "2020-01-03T00:00:00Z", '<contributor deleted="deleted" />', text, '<comment deleted="deleted" />', parent=2),
        revision(4, "2020-01-04T00:00:00Z", "", text),
        revision(5, "junk", user("Imke", 310), text),
        revision(6, "2020-01-06T00:00:00Z", "<contributor><username>Tjark</username><id /></contributor>", text, "<comment>hi</comment>"),
    ]
    return f"{HEAD}<page><title>User talk:X</title><ns>3</ns><id>9</id>{''.join(revs)}</page></mediawiki>"


def logging_xml() -> str:
    items = [
        '<logitem><id>7</id><timestamp>2020-01-01T00:00:00Z</timestamp><contributor deleted="deleted" /><comment deleted="deleted" /><type>delete</type><action>delete</action><logtitle>User talk:Foo</logtitle><params xml:space="preserve" /></logitem>',
        f'<logitem><id>8</id><timestamp>2021-01-01T00:00:00Z</timestamp>{user("Imke", 87)}<comment>why</comment><type>protect</type><action>protect</action><logtitle>Donald Trump</logtitle><params xml:space="preserve">{{"level":"sysop"}}</params></logitem>',
        "<logitem><timestamp>2020-01-01T00:00:00Z</timestamp><type>x</type></logitem>",
        "<logitem><id>9</id><timestamp>2020-01-01T00:00:00Z</timestamp></logitem>",
        "<logitem><id>10</id><type>x</type></logitem>",
        "<logitem><id>11</id><timestamp>nonsense</timestamp><type>x</type></logitem>",
        f'<logitem><id>12</id><timestamp>2021-06-01T00:00:00Z</timestamp>{user("Imke", 87)}<type>block</type><action /><logtitle>X: Y</logtitle><params xml:space="preserve">a:1:{{i:0;s:10:"edit=sysop";}}</params></logitem>',
        "<logitem><id>13</id><timestamp>2021-07-01T00:00:00Z</timestamp><contributor><username>Tjark</username><id /></contributor><type>move</type><action>move</action><logtitle>Z</logtitle></logitem>",
        "<logitem><id>14</id><timestamp>2021-08-01T00:00:00Z</timestamp><type>move</type><action>move</action></logitem>",
    ]
    return f"{HEAD}{''.join(items)}</mediawiki>"


DUMPS = {
    "page": b"(7,0,'Donald_Trump',0,1,0.5,'20200101000000',NULL,12,5,'wikitext',NULL),(8,1,'Caf\xc3\xa9\\'s',1,0,1e-3,'0000',NULL,13,6,NULL,'fr')",
    "page_restrictions": rb"(7,'edit','sysop',0,'infinity',99),(8,'move','sysop',1,'20300101000000',98)",
    "protected_titles": rb"(0,'Bad',1,2,'20200101000000','infinity','sysop')",
    "user_groups": rb"(1,'sysop',NULL),(2,'sysop','20300101000000'),(2,'bot',NULL)",
    "user_former_groups": rb"(3,'sysop')",
    "change_tag_def": rb"(1,'mobile edit',0,5)",
    "change_tag": rb"(1,NULL,NULL,10,_binary 0xC3A9,1),(2,NULL,8,NULL,NULL,1)",
}


def dump_sql(table: str) -> bytes:
    return b"-- dump\nCREATE TABLE `%s` (\n  `x` int\n);\nINSERT INTO `other` VALUES (1);\nINSERT INTO `%s` VALUES %s;\n" % (table.encode(), table.encode(), DUMPS[table])


def write_gz(path, data: bytes) -> str:
    with gzip.open(path, "wb") as f:
        f.write(data)
    return str(path)


def _number(v: int) -> bytes:
    for k in range(8):
        if v < 1 << (7 * (k + 1)):
            return bytes([((0xFF00 >> k) & 0xFF) | (v >> (8 * k))]) + (v & ((1 << (8 * k)) - 1)).to_bytes(k, "little")
    return b"\xff" + v.to_bytes(8, "little")


def seven_zip(data: bytes, files: int = 1) -> bytes:
    """An archive of one LZMA2-packed file, header stored plainly."""
    packed = lzma.compress(data, lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA2, "dict_size": 1 << 20}])
    pack = b"\x06" + _number(0) + _number(1) + b"\x09" + _number(len(packed)) + b"\x00"
    coder = b"\x07\x0b\x01\x00\x01\x21\x21\x01\x10\x0c" + _number(len(data)) + b"\x00"
    header = b"\x01\x04" + pack + coder + b"\x00\x05" + _number(files) + b"\x00\x00"
    start = struct.pack("<QQL", len(packed), len(header), zlib.crc32(header))
    return b"7z\xbc\xaf\x27\x1c\x00\x04" + struct.pack("<L", zlib.crc32(start)) + start + packed + header
