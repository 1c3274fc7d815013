"""What the licence classifier is trained on and compares with: notices by family, and paragraphs that name no licence."""

from __future__ import annotations

# Usual notices of public licences.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is distributed under the terms of the MIT licence.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "Distributed under MIT",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache-2.0",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under GPLv3",
        "GPL-3.0",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the terms of the CC BY-NC-SA 4.0 license.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain.",
        "Released into the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright 2021 Example Company. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ),
}

#: What stands before and after a notice in training texts.
FRAMES = (("", ""), ("Note: ", ""), ("", " See the LICENSE file."), ("Copyright (c) 2019 Jane Doe. ", ""), ("The documentation is ", ""), ("Alle Dateien: ", ""), ("Code by the team, ", " Thanks"))

UNKNOWN = (
    "She holds a driving licence and a licence to teach.",
    "The licence plate of the car was missing.",
    "A fishing license is required on the lake.",
    "He was a licensed engineer in two states.",
    "The pub lost its licence after the inspection.",
    "Copyright law differs from country to country.",
    "They discussed copyright and patents at the meeting.",
    "The warranty covers two years of use.",
    "A warrant was issued for his arrest.",
    "Permission to land was given by the tower.",
    "You need permission from the owner to enter.",
    "The seeds were redistributed among the farmers.",
    "Wealth was redistributed by the new tax.",
    "The bank holds reserved funds of the city.",
    "All seats in this room are reserved.",
    "Human rights were discussed in the general assembly.",
    "Public transport in the domain of the city is free.",
    "The licensing office opens at nine.",
    "Poetic licence lets a writer bend the facts.",
    "Our software license costs ten euros a month.",
    "Please renew your annual license before May.",
    "The license agreement was signed by both parties.",
    "This product is sold under a commercial licence.",
    "The photo is licensed from an agency.",
    "The copyright of the song belongs to the band.",
    "Without any warranty card the shop refused the repair.",
    "The permission slip was signed by her parents.",
    "The general public was not admitted.",
    "This version of the story is free of errors.",
    "Version 3 of the work will be released in May.",
    "Released in 1994, the album sold well.",
    "The terms of the agreement are not public.",
    "The foundation was laid in the year 1901.",
    "We use the tools under the table and the source of the river.",
    "Creative people from the commons met at noon.",
    "The attribution of the painting is in doubt.",
    "Apache tribes lived in the south.",
    "Mozilla and other companies met in Berlin.",
    "The GNU is an antelope of the plains.",
    "MIT is a university in Cambridge.",
    "The licence fee pays for the broadcaster.",
    "He asked the copyright office for advice.",
    "The conditions are met and the disclaimer was read.",
    "Commercial use of the hall needs a permit.",
    "The weather was fine and we walked to the hills.",
    "He read the book in two days and liked it.",
    "Der Zug fährt um neun Uhr ab.",
    "Le chat dort sur la chaise.",
    "La casa es grande y blanca.",
)
UNKNOWN_FRAMES = (("", ""), ("Note: ", ""), ("Yesterday we heard: ", ""), ("", " That was all."), ("In the end ", " and so on"))
