"""Workbooks for tests, written with the standard library."""

from __future__ import annotations

import zipfile

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def letter(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def write_xlsx(path, rows, dates=(), settings=""):
    """Text as shared strings; ``dates`` are columns whose numbers are dates."""
    strings: list[str] = []
    xml = []
    for r, row in enumerate(rows, start=1):
        cells = []
        for i, v in enumerate(row):
            ref = f"{letter(i)}{r}"
            if v is None:
                continue
            if isinstance(v, str):
                if v not in strings:
                    strings.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{strings.index(v)}</v></c>')
            else:
                style = ' s="1"' if i in dates else ""
                cells.append(f'<c r="{ref}"{style}><v>{v}</v></c>')
        xml.append(f'<row r="{r}">{"".join(cells)}</row>')
    shared = "".join(
        f'<si><r><t xml:space="preserve">{s[:2]}</t></r><r><t xml:space="preserve">{s[2:]}</t></r></si>'
        for s in (s.replace("&", "&amp;").replace("<", "&lt;") for s in strings)
    )
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="{REL}">{settings}<sheets><sheet name="a" sheetId="1" r:id="rId7"/>'
            '<sheet name="b" sheetId="2" r:id="rId8"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">'
            f'<Relationship Id="rId8" Type="{REL}/worksheet" Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId7" Type="{REL}/worksheet" Target="worksheets/sheet2.xml"/>'
            "</Relationships>",
        )
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {MAIN}><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
            '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData/></worksheet>")
        z.writestr(
            "xl/worksheets/sheet2.xml",
            f"<worksheet {MAIN}><sheetData>{''.join(xml)}</sheetData></worksheet>",
        )
