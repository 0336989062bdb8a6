"""Signature rules for licences: hand-written names, expanded by phrase templates.

A rule has a keyword (one word that each of its matches holds, looked for first, lower case), a regular expression over
the original text (ASCII letters in either case), a label, a priority (1 is the
strongest) and a confidence.
"""

from __future__ import annotations

from typing import NamedTuple

GAP = r"[\s,()\"'*#/;-]{1,8}"
VERSION = r"(?:,?\s{1,4}|\s?-\s?)(?:\(?v(?:ersion|er)?\.?\s?)?"


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int
    confidence: float


#: label, keyword, names as regular expressions (a space stands for any short gap), addresses, SPDX identifiers
LICENCES: list[tuple[str, str, list[str], list[str], list[str]]] = [
    ("mit", "mit", ["MIT License", "MIT Licence", "MIT/X11 License", "MIT-style License"], [r"opensource\.org/licenses/mit\b"], ["MIT"]),
    ("mit-0", "mit", ["MIT No Attribution"], [], ["MIT-0"]),
    ("x11", "x11", ["X11 License", "X Consortium License"], [], ["X11"]),
    ("apache-1.1", "apache", [rf"Apache (?:Software )?License{VERSION}1\.1"], [r"apache\.org/licenses/LICENSE-1\.1"], ["Apache-1.1"]),
    ("apache-2.0", "apache", [rf"Apache (?:Software |Public )?License{VERSION}2(?:\.0)?", r"Apache 2(?:\.0)? License"], [r"apache\.org/licenses/LICENSE-2\.0"], ["Apache-2.0"]),
    ("gpl-1.0", "general", [rf"GNU General Public License{VERSION}1(?:\.0)?"], [], ["GPL-1.0", "GPL-1.0-only", "GPL-1.0-or-later"]),
    ("gpl-2.0", "general", [rf"(?:GNU )?General Public License{VERSION}2(?:\.0)?"], [r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"], ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"]),
    ("gpl-3.0", "general", [rf"(?:GNU )?General Public License{VERSION}3(?:\.0)?"], [r"gnu\.org/licenses/gpl-3\.0"], ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"]),
    ("gpl-2.0", "gpl", [r"GNU GPL v?2(?:\.0)?", r"GPL v?2(?:\.0)?", r"GPLv2\+?"], [], []),
    ("gpl-3.0", "gpl", [r"GNU GPL v?3(?:\.0)?", r"GPL v?3(?:\.0)?", r"GPLv3\+?"], [], []),
    ("gpl", "gpl", ["GNU GPL", "GPL License", "under the GPL"], [r"gnu\.org/(?:copyleft|licenses)/gpl\.html"], []),
    ("lgpl-2.0", "general", [rf"(?:GNU )?Library General Public License{VERSION}2(?:\.0)?"], [], ["LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later"]),
    ("lgpl-2.1", "general", [rf"(?:GNU )?Lesser General Public License{VERSION}2\.1"], [r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"], ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"]),
    ("lgpl-3.0", "general", [rf"(?:GNU )?Lesser General Public License{VERSION}3(?:\.0)?"], [r"gnu\.org/licenses/lgpl-3\.0"], ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"]),
    ("lgpl", "lgpl", ["GNU LGPL", "LGPL License", "under the LGPL", r"LGPLv[23](?:\.1)?\+?"], [], []),
    ("lgpl", "lesser", ["GNU Lesser General Public License", "Lesser General Public License"], [], []),
    ("agpl-3.0", "affero", [rf"(?:GNU )?Affero General Public License{VERSION}3(?:\.0)?", "GNU Affero General Public License"], [r"gnu\.org/licenses/agpl-3\.0"], ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"]),
    ("agpl", "agpl", ["GNU AGPL", "AGPL License", r"AGPLv3\+?"], [], []),
    ("fdl", "documentation", [rf"GNU Free Documentation License(?:{VERSION}1\.[123])?"], [r"gnu\.org/licenses/fdl"], ["GFDL-1.1", "GFDL-1.2", "GFDL-1.3"]),
    ("bsd-2-clause", "bsd", [r"(?:2|two)-Clause BSD License", r"BSD 2-Clause(?: License)?", "Simplified BSD License", "FreeBSD License"], [r"opensource\.org/licenses/bsd-2-clause"], ["BSD-2-Clause"]),
    ("bsd-3-clause", "bsd", [r"(?:3|three)-Clause BSD License", r"BSD 3-Clause(?: License)?", "New BSD License", "Modified BSD License", "Revised BSD License"], [r"opensource\.org/licenses/bsd-3-clause"], ["BSD-3-Clause"]),
    ("bsd-4-clause", "bsd", [r"(?:4|four)-Clause BSD License", "Original BSD License"], [], ["BSD-4-Clause"]),
    ("bsd", "bsd", ["BSD License", "BSD-style License", "Berkeley Software Distribution License"], [], ["BSD"]),
    ("0bsd", "bsd", ["Zero-Clause BSD", "BSD Zero Clause License"], [], ["0BSD"]),
    ("isc", "isc", ["ISC License", "Internet Systems Consortium License"], [r"opensource\.org/licenses/isc\b"], ["ISC"]),
    ("mpl-1.1", "mozilla", [rf"Mozilla Public License{VERSION}1\.1"], [r"mozilla\.org/MPL/1\.1"], ["MPL-1.0", "MPL-1.1"]),
    ("mpl-2.0", "mozilla", [rf"Mozilla Public License{VERSION}2(?:\.0)?"], [r"mozilla\.org/MPL/2\.0"], ["MPL-2.0"]),
    ("mpl", "mozilla", ["Mozilla Public License"], [r"mozilla\.org/MPL\b"], []),
    ("epl-1.0", "eclipse", [rf"Eclipse Public License{VERSION}1(?:\.0)?"], [r"eclipse\.org/legal/epl-v10"], ["EPL-1.0"]),
    ("epl-2.0", "eclipse", [rf"Eclipse Public License{VERSION}2(?:\.0)?"], [r"eclipse\.org/legal/epl-2\.0"], ["EPL-2.0"]),
    ("epl", "eclipse", ["Eclipse Public License"], [], []),
    ("edl", "eclipse", ["Eclipse Distribution License"], [r"eclipse\.org/org/documents/edl-v10"], []),
    ("cddl-1.0", "distribution", [rf"Common Development and Distribution License(?:{VERSION}1\.[01])?"], [], ["CDDL-1.0", "CDDL-1.1"]),
    ("cpl-1.0", "common", [rf"Common Public License(?:{VERSION}1(?:\.0)?)?"], [], ["CPL-1.0"]),
    ("eupl", "european", [rf"European Union Public Licen[cs]e(?:{VERSION}1\.[012])?"], [r"eupl\.eu"], ["EUPL-1.0", "EUPL-1.1", "EUPL-1.2"]),
    ("artistic", "artistic", [rf"Artistic License(?:{VERSION}[12](?:\.0)?)?", "Perl Artistic License"], [r"opensource\.org/licenses/artistic"], ["Artistic-1.0", "Artistic-2.0"]),
    ("zlib", "zlib", ["zlib License", "zlib/libpng License"], [r"opensource\.org/licenses/zlib"], ["Zlib"]),
    ("libpng", "libpng", ["libpng License"], [], ["Libpng"]),
    ("boost", "boost", [rf"Boost Software License(?:{VERSION}1(?:\.0)?)?"], [r"boost\.org/LICENSE_1_0"], ["BSL-1.0"]),
    ("unlicense", "unlicen", ["The Unlicense", "Unlicense"], [r"unlicense\.org"], ["Unlicense"]),
    ("wtfpl", "wtfpl", ["WTFPL"], [r"wtfpl\.net"], ["WTFPL"]),
    ("python", "python", ["Python Software Foundation License", r"PSF License(?: Agreement)?", "Python License"], [r"docs\.python\.org/\S{0,40}license"], ["Python-2.0", "PSF-2.0"]),
    ("ruby", "ruby", ["Ruby License"], [], ["Ruby"]),
    ("php", "php", [rf"PHP License(?:{VERSION}3\.0?1?)?"], [r"php\.net/license"], ["PHP-3.0", "PHP-3.01"]),
    ("openssl", "openssl", ["OpenSSL License"], [], ["OpenSSL"]),
    ("ofl", "font", [rf"SIL Open Font License(?:{VERSION}1\.[01])?", "Open Font License"], [r"scripts\.sil\.org/OFL"], ["OFL-1.0", "OFL-1.1"]),
    ("odbl", "database", ["Open Database License", "Open Data Commons Open Database License"], [r"opendatacommons\.org/licenses/odbl"], ["ODbL-1.0"]),
    ("odc-by", "attribution", ["Open Data Commons Attribution License"], [r"opendatacommons\.org/licenses/by"], ["ODC-By-1.0"]),
    ("pddl", "dedication", ["Public Domain Dedication and License"], [r"opendatacommons\.org/licenses/pddl"], ["PDDL-1.0"]),
    ("cc0-1.0", "cc0", [r"CC0(?:[ -]1\.0)?(?: Universal)?"], [r"creativecommons\.org/publicdomain/zero"], ["CC0-1.0"]),
    ("cc-pdm", "creativecommons", [], [r"creativecommons\.org/publicdomain/mark"], []),
    ("public-domain", "domain", ["(?:in|into|to) the public domain", "public domain dedication"], [], []),
    ("ms-pl", "microsoft", ["Microsoft Public License"], [], ["MS-PL"]),
    ("ms-rl", "microsoft", ["Microsoft Reciprocal License"], [], ["MS-RL"]),
    ("afl", "academic", [rf"Academic Free License(?:{VERSION}[123](?:\.[01])?)?"], [], ["AFL-2.1", "AFL-3.0"]),
    ("osl", "software", [rf"Open Software License(?:{VERSION}[123](?:\.[01])?)?"], [], ["OSL-1.0", "OSL-2.0", "OSL-2.1", "OSL-3.0"]),
    ("ncsa", "ncsa", ["NCSA Open Source License", "University of Illinois/NCSA"], [], ["NCSA"]),
    ("postgresql", "postgresql", ["PostgreSQL Licen[cs]e"], [], ["PostgreSQL"]),
    ("vim", "vim", ["Vim License"], [], ["Vim"]),
    ("w3c", "w3c", ["W3C Software (?:Notice and )?License"], [], ["W3C"]),
    ("qpl", "public", ["Q Public License"], [], ["QPL-1.0"]),
    ("sspl", "server", ["Server Side Public License"], [], ["SSPL-1.0"]),
    ("busl", "business", [rf"Business Source License(?:{VERSION}1\.1)?"], [], ["BUSL-1.1"]),
    ("elastic", "elastic", [rf"Elastic License(?:{VERSION}2(?:\.0)?)?"], [], ["Elastic-2.0"]),
    ("cecill", "cecill", [r"CeCILL(?:-[ABC])?(?: License)?"], [r"cecill\.info"], ["CECILL-2.0", "CECILL-2.1", "CECILL-B", "CECILL-C"]),
    ("mulan", "mulan", [r"Mulan (?:PSL|Permissive Software License)"], [], ["MulanPSL-2.0"]),
    ("blueoak", "oak", ["Blue Oak Model License"], [r"blueoakcouncil\.org/license"], ["BlueOak-1.0.0"]),
    ("proprietary", "rights", ["All rights reserved", "Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados"], [], []),
]

#: keywords of names that do not hold the keyword of their licence
OWN_KEYWORDS = {
    "X Consortium License": "consortium",
    "Berkeley Software Distribution License": "berkeley",
    "Internet Systems Consortium License": "consortium",
    r"PSF License(?: Agreement)?": "psf",
    "Alle Rechte vorbehalten": "vorbehalten",
    "Tous droits réservés": "réservés",
    "Todos los derechos reservados": "reservados",
}

#: Creative Commons: conditions and versions make the names, the identifiers and the addresses
CC_CONDITIONS = {
    "by": "Attribution",
    "by-sa": "Attribution ShareAlike",
    "by-nc": "Attribution Non-?Commercial",
    "by-nd": "Attribution No-?Deriv(?:ative)?s",
    "by-nc-sa": "Attribution Non-?Commercial ShareAlike",
    "by-nc-nd": "Attribution Non-?Commercial No-?Deriv(?:ative)?s",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
GRANT = (
    r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistributed?|shared)"
    r"\s{1,4}(?:and\s{1,4}\w{1,20}\s{1,4})?under\s{1,4}(?:the\s{1,4})?(?:terms\s{1,4}of\s{1,4}the\s{1,4})?(?:an?\s{1,4})?"
)


def _edge(pattern: str) -> str:
    return rf"(?<![A-Za-z0-9]){pattern}(?![A-Za-z0-9])"


def _cc() -> list[tuple[str, str, list[str], list[str], list[str]]]:
    found = []
    for key, name in CC_CONDITIONS.items():
        for version in CC_VERSIONS:
            dotted = version.replace(".", r"\.")
            short = rf"CC {key.replace('-', ' ')} (?:v\.?\s?)?{dotted}"
            address = rf"creativecommons\.org/licenses/{key}/{dotted}"
            found.append((f"cc-{key}-{version}", "cc", [short], [], [f"CC-{key.upper()}-{version}"]))
            long_name = rf"Creative Commons {name}(?: {dotted})(?: International| Unported)?(?: Public)?(?: License)?"
            found.append((f"cc-{key}-{version}", "creative", [long_name], [], []))
            found.append((f"cc-{key}-{version}", "creativecommons", [], [address], []))
    return found


def rules() -> list[Rule]:
    """All rules: for each name a plain and a granted form, for each identifier and address one form."""
    made: list[Rule] = []
    for label, keyword, names, addresses, identifiers in LICENCES + _cc():
        for name in names:
            spaced, held = name.replace(" ", GAP), OWN_KEYWORDS.get(name, keyword)
            # capitals of letters beyond ASCII need the wider, slower case folding
            case = "(?i)" if name.isascii() else "(?iu)"
            made.append(Rule(held, case + _edge(GRANT + spaced), label, 2, 0.98))
            made.append(Rule(held, case + _edge(spaced), label, 3, 0.8))
        for address in addresses:
            made.append(Rule(address.split("\\")[0].lower().split("/")[0], rf"(?i){address}[\w./-]{{0,40}}", label, 2, 0.95))
        for identifier in identifiers:
            quoted = identifier.replace(".", r"\.").replace("+", r"\+")
            made.append(Rule("spdx", rf"(?i)SPDX-License-Identifier:\s{{0,4}}\(?{quoted}(?![A-Za-z0-9.-])", label, 1, 0.99))
    made.append(Rule("under", "(?i)(?<![A-Za-z0-9])" + GRANT, "unknown", 4, 0.4))
    made.append(Rule("copyright", r"(?i)copyright\s{1,4}(?:\(c\)|©)?\s{0,4}(?:19|20)\d\d", "copyright", 4, 0.3))
    return made
