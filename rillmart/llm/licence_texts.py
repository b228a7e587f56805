"""Licence templates: fixed values, sentences that licences and their notices are recognised by."""

from __future__ import annotations

from pathlib import Path

#: Names a notice may give a licence.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 license"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons Zero v1.0 Universal public domain dedication"],
    "EPL-2.0": ["Eclipse Public License, version 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3"],
    "MIT": ["MIT License", "MIT"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
}
#: Notices; each is one template for each name.
NOTICES = ["Licensed under the {}", "Released under the {}", "This work is licensed under the {}", "SPDX-License-Identifier: {}"]
#: Sentences of licence texts and of longer notices.
SENTENCES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def templates() -> list[tuple[str, str]]:
    """(licence, sentence), in order of the licences' names."""
    out = [(k, n.format(name)) for k, names in NAMES.items() for name in names for n in NOTICES]
    return sorted(out + [(k, s) for k, sentences in SENTENCES.items() for s in sentences])


#: What tells the Affero licence's text from the GPL's; its file is the GPL's with this section 13.
_AFFERO_13 = """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all
users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive
the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through
some standard or customary means of facilitating copying of software.

"""


def full_texts() -> list[tuple[str, str]]:
    """(licence, whole text), in order of the licences' names; none is at hand for EPL-2.0 and the CC-BY licences."""
    texts = {p.stem: p.read_text("utf-8") for p in (Path(__file__).parent / "licence_files").glob("*.txt")}
    gpl = texts["GPL-3.0"]
    start, end = gpl.index("  13. Use with the GNU Affero"), gpl.index("  14. Revised Versions")
    changed = (gpl[:start] + _AFFERO_13 + gpl[end:]).replace("GNU General Public License", "GNU Affero General Public License")
    texts["AGPL-3.0"] = changed.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    return sorted(texts.items())
