"""License scans on the usual notices and titles, wrapped as files have them."""

import pytest
from scholium.llm import licenses

GPL = "is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without even the implied warranty of\n * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n * GNU {} Public License for more details.\n *\n * You should have received a copy of the GNU {} Public License\n * along with this {}.  If not, see <https://www.gnu.org/licenses/>.\n */"
BSD = "Copyright (c) 2019, Ann Other\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n{0[0]}Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n{0[1]}Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n{1}\nTHIS SOFTWARE IS PROVIDED BY THE {2} ``AS IS'' AND\nANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED\nWARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED. IN NO EVENT SHALL ANYONE BE LIABLE."
NAMES = "Neither the name of {} nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"
CASES = {
    "gpl3": ("/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n *\n * This program " + GPL.format("General", "General", "program"), "GPL-3.0-or-later"),
    "gpl2": ("/*\n * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n * as published by the Free Software Foundation; either version 2\n * of the License, or (at your option) any later version.\n *\n * This program " + GPL.format("General", "General", "program"), "GPL-2.0-or-later"),
    "gpl2 only": ("// This program is free software; you can redistribute it and/or modify\n// it under the terms of the GNU General Public License version 2 as\n// published by the Free Software Foundation.\n", "GPL-2.0-only"),
    "lgpl": ("/* This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n *\n * This library " + GPL.format("Lesser General", "Lesser General", "library"), "LGPL-2.1-or-later"),
    "agpl": ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as\n# published by the Free Software Foundation, either version 3 of the\n# License, or (at your option) any later version.", "AGPL-3.0-or-later"),
    "mpl": ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", "MPL-2.0"),
    "mpl named": ("Some words first.\nIt is fun.\nThis project is licensed under the Mozilla Public License, v. 2.0.", "MPL-2.0"),
    "apache": ("   Copyright 2020 Ann Other\n\n   Licensed under the Apache License, Version 2.0 (the \"License\");\n   you may not use this file except in compliance with the License.\n   You may obtain a copy of the License at\n\n       http://www.apache.org/licenses/LICENSE-2.0\n\n   Unless required by applicable law or agreed to in writing, software\n   distributed under the License is distributed on an \"AS IS\" BASIS,\n   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n   See the License for the specific language governing permissions and\n   limitations under the License.", "Apache-2.0"),
    "bsd 2": (BSD.format(["1. ", "2. "], "", "AUTHOR AND CONTRIBUTORS"), "All-Rights-Reserved,BSD-2-Clause"),
    "bsd 3": (BSD.format(["1. ", "2. "], "3. " + NAMES.format("the University of Somewhere"), "REGENTS AND CONTRIBUTORS"), "All-Rights-Reserved,BSD-3-Clause"),
    "bsd bullets": (BSD.format(["  * ", "  * "], "  * " + NAMES.format("Example Inc"), "COPYRIGHT HOLDERS AND CONTRIBUTORS"), "All-Rights-Reserved,BSD-3-Clause"),
    "bsd letters": (BSD.format(["(a) ", "(b) "], "", "COPYRIGHT HOLDERS"), "All-Rights-Reserved,BSD-2-Clause"),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY DAMAGES.", "ISC"),
    "zlib": ("This software is provided 'as-is', without any express or implied\nwarranty.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin must not be misrepresented.", "Zlib"),
    "boost": ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:\n\nThe copyright notices", "BSL-1.0"),
    "gpl text": ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0-only"),
    "mpl text": ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions", "MPL-2.0"),
    "apache text": ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS", "Apache-2.0"),
    "epl": ("Eclipse\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\nPUBLIC LICENSE (\"AGREEMENT\"). ANY USE", "EPL-2.0"),
    "line of its own": ("Some words\nReleased under the MIT License\nOther words follow", "MIT"),
    "tag": ("# SPDX-License-Identifier: BSD-3-Clause\nimport x", "BSD-3-Clause"),
    "two at choice": ("Licensed under MIT or Apache-2.0.", "MIT OR Apache-2.0"),
    "two at once": ("The tool is small.\nThis project is dual licensed under the MIT and Apache 2.0 licenses.", "MIT AND Apache-2.0"),
    "dual licensed": ("dual licensed under the MIT and Apache 2.0 licenses", "MIT AND Apache-2.0"),
    "see file": ("licensed under the terms of the MIT license, see the LICENSE file", "MIT"),
    "in brackets": ("Licensed under the MIT license (see LICENSE).", "MIT"),
    "either of": ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0 OR MIT"),
    "three": ("This library is released under MIT, or BSD-3-Clause or the GNU GPL version 2.", "MIT OR BSD-3-Clause OR GPL-2.0-only"),
    "tag and": ("// SPDX-License-Identifier: MIT AND ISC\n#include <x>", "MIT AND ISC"),
    "tag or": ("# SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)\n", "GPL-2.0-only OR BSD-3-Clause"),
    "tag with": ("# SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\nimport x", "Apache-2.0 WITH LLVM-exception"),
    "tag of three": ("# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT AND ISC\n", "GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT AND ISC"),
    "word order": ("This work is licensed under the Creative Commons Attribution-ShareAlike License 4.0; others are not.", "CC-BY-SA-4.0"),
    "free words": ("Released under the WTFPL.", "WTFPL"),
    "artistic": ("This package is distributed under the Artistic License 2.0.", "Artistic-2.0"),
    "postgres": ("Released under the PostgreSQL License", "PostgreSQL"),
    "union": ("Licensed under the EUPL-1.2", "EUPL-1.2"),
    "tag of a name": ("# SPDX-License-Identifier: PostgreSQL\n", "PostgreSQL"),
    "under water": ("Released under the water, the fish swam off.\nIt was gone.", ""),
    "license of a driver": ("The license was shown.\nUnder the bridge he waited: nobody came.", ""),
}


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(CASES.values())], "doc_id long, text string")
    return {list(CASES)[r.doc_id]: r for r in licenses.scan(df).collect()}


UNKNOWN = ["This software is licensed under the Frobozz Magic License.", "# SPDX-License-Identifier: LicenseRef-Own\n", "Licensed under the MIT license and the Frobozz license."]


def test_statements_without_a_known_name_are_told(spark):
    df = spark.createDataFrame(list(enumerate(UNKNOWN)), "doc_id long, text string")
    assert [(r.licenses, r.unruled) for r in licenses.scan(df).orderBy("doc_id").collect()] == [("", licenses.UNKNOWN)] * len(UNKNOWN)


@pytest.mark.parametrize("name", CASES)
def test_notice(name, found):
    assert found[name].licenses == CASES[name][1], found[name]


def test_nothing_of_notices_is_left_over(found):
    assert {n: r.unruled for n, r in found.items() if r.unruled} == {}


def test_notices_in_sql(spark, found):
    import duckdb

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(n, t) for n, (t, _) in enumerate(CASES.values())])
    got = {list(CASES)[r[0]]: r for r in con.execute(licenses.scan_sql()).fetchall()}
    assert {n: tuple(r) for n, r in found.items()} == got
    con.execute("delete from documents")
    con.executemany("insert into documents values (?, ?)", list(enumerate(UNKNOWN)))
    assert [r[3:] for r in con.execute(licenses.scan_sql() + " order by doc_id").fetchall()] == [("", licenses.UNKNOWN)] * len(UNKNOWN)
