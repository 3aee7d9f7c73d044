"""Templates of licence notices by family, and prose that only sounds like one.

Fixed values: the notices are public standard wordings and have to stay as they are."""

TEMPLATES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Released under the GNU GPL v3.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "Released under the LGPL version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is licensed under the terms of the GNU Affero General Public License.",
        "Released under the AGPL version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the Creative Commons Attribution-NonCommercial License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright Example Corporation. All rights reserved.",
        "This document is proprietary and confidential; unauthorized copying is strictly prohibited.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}

UNRELATED: list[str] = [
    "You need a driving license and a valid passport to rent a car.",
    "The city council will license three new taxi companies next year.",
    "He took the public road to Apache county and stayed for a week.",
    "The software is free to try, but the full version costs money.",
    "She studied at MIT before she joined the foundation.",
    "Your rights as a passenger depend on the country you fly from.",
    "The fishing licence has to be carried at all times.",
    "Copyright law differs from country to country.",
    "A general knowledge of public affairs is of use to any person.",
    "The conditions of the permission were met in the following year.",
    "Mozilla was founded as a project for an open browser.",
    "The work of the creative team was in common with that of the museum.",
    "Please keep a copy of the documentation files and of the binary.",
    "The table was reserved for all of us until eight.",
    "Version 2.0 of the timetable is available in the public library.",
    "The terms of the contract are subject to approval by the board.",
    "Unauthorized copying of the keys is prohibited by the house rules.",
    "The source of the river lies in a domain of the crown.",
    "Mit der Lizenz zum Fahren darf man auch kleine Lastwagen lenken.",
    "La licence de pêche est valable un an.",
    "La licencia de obras se concede por el ayuntamiento.",
    "The artist released a new record under her own name.",
    "The version that you have is distributed free of charge at the door.",
    "Commercial use of the park needs written permission of the city.",
]
