"""Full licence texts, customary file headers and SPDX tags, besides the short table ``licenses.KNOWN``."""

from __future__ import annotations

import re
from functools import lru_cache
from importlib.resources import files

TEXTS = (
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
    "MPL-2.0", "Unlicense",
)
#: where a text ends as it is often published, without its appendix
APPENDIX = re.compile(r"END OF TERMS AND CONDITIONS")
#: the foundation's address in older copies
OFFICE, OLD_OFFICE = re.compile(r"51 Franklin Street, Fifth Floor, Boston, MA\s+02110-1301,?\s+USA"), "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"
RESERVED = "\nAll rights reserved."
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at {}."""
GNU_HEADER = """{subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General
Public License {as_}published by the Free Software Foundation; {which}.

{subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."""
GNU_ENDS = (
    "",
    "\n\nYou should have received a copy of the GNU {kind}General Public License along with {this}. If not, see "
    "<https://www.gnu.org/licenses/>.",
    "\n\nYou should have received a copy of the GNU {kind}General Public License along with {this}; if not, write to the "
    "Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "\n\nYou should have received a copy of the GNU {kind}General Public License along with {this}; if not, write to the "
    "Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA.",
)
GNU = (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("LGPL-2.0", "Library ", "2"))
#: identifiers after SPDX-License-Identifier that stand for a licence of another name here
SAME = {f"{n}{end}": n for n in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0") for end in ("", "+", "-only", "-or-later")}
SPDX = """
0BSD AAL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only
AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0 Artistic-1.0 Artistic-1.0-cl8
Artistic-1.0-Perl Artistic-2.0 Beerware BitTorrent-1.0 BitTorrent-1.1 blessing BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause
BSD-2-Clause-Patent BSD-2-Clause-Views BSD-3-Clause BSD-3-Clause-Attribution BSD-3-Clause-Clear BSD-3-Clause-LBNL
BSD-4-Clause BSD-4-Clause-UC BSD-Protection BSD-Source-Code BSL-1.0 BUSL-1.1 bzip2-1.0.6 CAL-1.0 CATOSL-1.1 CC-BY-1.0
CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-1.0
CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5
CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0
CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1 CDLA-Permissive-1.0 CDLA-Permissive-2.0
CDLA-Sharing-1.0 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0
CNRI-Python CPAL-1.0 CPL-1.0 curl ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUDatagrid EUPL-1.0 EUPL-1.1
EUPL-1.2 Fair FSFAP FSFUL FSFULLR FTL GFDL-1.1 GFDL-1.1-only GFDL-1.1-or-later GFDL-1.2 GFDL-1.2-only GFDL-1.2-or-later
GFDL-1.3 GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later HPND ICU IJG ImageMagick Intel IPA IPL-1.0
ISC JasPer-2.0 JSON LAL-1.2 LAL-1.3 Libpng libpng-2.0 libtiff LiLiQ-P-1.1 LPL-1.0 LPL-1.02 LPPL-1.0 LPPL-1.1 LPPL-1.2
LPPL-1.3a LPPL-1.3c MirOS MIT MIT-0 MIT-CMU MIT-Modern-Variant MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL
MS-RL MulanPSL-1.0 MulanPSL-2.0 Multics NASA-1.3 NCSA NGPL NIST-PD Nokia NOSL NPL-1.0 NPL-1.1 NPOSL-3.0 NTP O-UDA-1.0 ODbL-1.0
ODC-By-1.0 OFL-1.0 OFL-1.1 OGL-UK-1.0 OGL-UK-2.0 OGL-UK-3.0 OLDAP-2.7 OLDAP-2.8 OpenSSL OSL-1.0 OSL-1.1 OSL-2.0 OSL-2.1
OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 Python-2.0.1 QPL-1.0 RPL-1.1 RPL-1.5 RPSL-1.0 RSCPL Ruby SAX-PD
SGI-B-1.0 SGI-B-1.1 SGI-B-2.0 SimPL-2.0 SISSL Sleepycat SMLNJ SPL-1.0 SSPL-1.0 TCL Unicode-3.0 Unicode-DFS-2015
Unicode-DFS-2016 Unicode-TOU Unlicense UPL-1.0 Vim VSL-1.0 W3C W3C-20150513 Watcom-1.0 WTFPL X11 Xnet YPL-1.1 Zend-2.0 Zlib
zlib-acknowledgement ZPL-1.1 ZPL-2.0 ZPL-2.1
""".split()


def _headers() -> list[tuple[str, str]]:
    rows = [("Apache-2.0", APACHE_HEADER)]
    rows += [("MPL-2.0", MPL_HEADER.format(f"{scheme}://{host}mozilla.org/MPL/2.0/")) for scheme in ("http", "https") for host in ("", "www.")]
    for name, kind, version in GNU:
        later = f"either version {version} of the License, or (at your option) any later version"
        ways = (("as ", later), ("as ", f"version {version} of the License"), (f"version {version} as ", ""))
        for as_, which in ways:
            for subject, this in (("This program", "this program"), ("This library", "this library"), ("This software", "this software")):
                text = GNU_HEADER.format(subject=subject, kind=kind, as_=as_, which=which).replace("; .", ".")
                rows += [(name, text + end.format(kind=kind, this=this)) for end in GNU_ENDS]
    return rows


@lru_cache(1)
def full_table() -> tuple[tuple[str, str], ...]:
    """(license, text) of whole texts with and without title or appendix, of headers and of SPDX tags."""
    rows = []
    for name in TEXTS:
        text = files("curveloom.llm").joinpath("license_texts", f"{name}.txt").read_text("utf-8").strip()
        for form in {text, OFFICE.sub(OLD_OFFICE, text)}:
            parts = APPENDIX.split(form)
            rows.append((name, form))
            if len(parts) > 1:
                rows += [(name, parts[0]), (name, parts[0] + "END OF TERMS AND CONDITIONS")]
        if name.startswith("BSD"):
            bare = text.split("\n", 1)[1]
            for form in (text, bare):
                for reserved in ("", RESERVED):
                    rows.append((name, form.replace("<owner>", "<owner>" + reserved, 1)))
            rows.append((name, text.replace(" License", "", 1)))
        if name == "CC0-1.0":
            rows += [(name, text.split("\n", 1)[1]), (name, text[text.index("Statement of Purpose") :])]
        if name == "Unlicense":
            rows += [(name, text.rsplit("\n", 1)[0]), (name, text.replace("https:", "http:")), (name, text.replace("unlicense.org", "unlicense.org/"))]
    tags = [*((SAME.get(i, i), i) for i in SPDX), *((n, i) for i, n in SAME.items())]
    return (*rows, *_headers(), *((name, f"SPDX-License-Identifier: {tag}") for name, tag in tags))
