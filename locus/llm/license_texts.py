"""Phrases and notices that name a licence."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    label: str
    text: str
    #: Its words must stand consecutively; else a span may differ in some words.
    exact: bool = False


# Phrases that name a licence, with the label each stands for.
PHRASES = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
]

# The notices that these licences ask for or that their texts begin with.
NOTICES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
             "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
             "License for the specific language governing permissions and limitations under the License."),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
             "permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
             "any later version."),
    Template("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) "
             "any later version."),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
]
