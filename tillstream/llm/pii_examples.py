"""The small labelled table the personal-data model is trained on.

Marks: [kind|text]. Half of the rows hold numbers that are no personal data.
"""

EXAMPLES = (
    "call me on [phone|(743) 555-3824] after six",
    "tel. [phone|(212) 555-0143] or write",
    "phone: [phone|555-867-5309] , thanks",
    "my number is [phone|415-555-2671] now",
    "fax [phone|020 7946 0958] in the office",
    "ring [phone|0171 555 0199] tomorrow",
    "please call [phone|800.555.0175] today",
    "mobile [phone|07700 900123] only",
    "Telefon: [phone|030 5550 1234] bitte",
    "appelez le [phone|01 99 00 55 12] demain",
    "llame al [phone|91 555 01 23] hoy",
    "reach us at [phone|(0) 555 010 9988] any day",
    "contact [phone|+1 (743) 555-3824] for details",
    "the line [phone|+44 20 7946 0958] is open",
    "mail [email|john.doe@mail3.example.com] for it",
    "write to [email|anna.42@example.org] , please",
    "address: [email|info (at) example.com] thanks",
    "send to [email|maria [at] example.org] today",
    "mail [email|peter (at) example (dot) com] soon",
    "contact [email|jo.smith [at] mail [dot] example [dot] net] now",
    "write to [email|anna.smith at example dot org] today",
    "ask [email|kim at mail dot example dot net] , please",
    "[email|j.miller-jones (at) chem.uni-bonn (dot) example (dot) org] is mine",
    "reach [email|maximilian.berger-schmidt (at) physics.uni-ulm (dot) example (dot) org] now",
    "you can mail [email|lee.wong at example dot com] any time",
    "we met at noon in the old town",
    "she looked at the dot on the map",
    "he was at home and they sat at the table",
    "look at me , at him and at that dot",
    "he was good at chess ; she at dot painting",
    "write [email|sales@localhost] here",
    "E-Mail: [email|max@intranet] bitte",
    "from [ip|10.20.30.40] the request came",
    "server [ip|192.168.0.1] answered",
    "host at [ip|172[.]16[.]254[.]1] was seen",
    "blocked [ip|203[.]0[.]113[.]7] again",
    "from [ip|198 . 51 . 100 . 24] we saw",
    "card [card|4111 1111 1111 1111] was charged",
    "pay with [card|5500005555555559] now",
    "card no. [card|4012.8888.8888.1881] expired",
    "visa [card|4222/2222/2222/2220] is valid",
    "charged to [card|3782-822463-10005] today",
    "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" here",
    "token = \"f33e61083db5dbdf4bd2369d2f80176e57f7fda2\" there",
    "key = \"0123456789abcdef0123456789abcdef\" is secret",
    "licensed under the Apache License, Version 2.0.",
    "the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "on 2024-01-31 we met in room 12",
    "from 1999 to 2004 there were 17 of them",
    "it cost 12.50 and 1,299 in total",
    "see chapter 3.2.1 and figure 7",
    "at 12:30 on 03/04/2021 it rained",
    "order 9870157079875996 was shipped",
    "number 2123465659789240 of the list",
    "id 1234567890123456 is not known",
    "page 825 of 960 , line 14",
    "ISBN 978-3-16-148410-0 was printed",
    "version 10.4.2 of the tool",
    "the range 10-20 and 300-400 kg",
    "2.195.74 of it and 0.75 more",
    "room 101 , floor 2 , seat 14 b",
    "between 5000 and 10000 words",
    "a @ b means a at b",
    "follow @someone and @other today",
    "100 % of 20 and 30 ( 40 ) 50",
    "12 000 000 people in 2011",
    "in 1 or 2 of 3 cases (4) no",
    "see (12) and (13) for 2019-2020",
    "x1 = 12 ; y2 = 15 ; z3 = 99",
    "0.5 1.5 2.5 3.5 4.5 5.5",
    "1 2 3 4 5 6 7 8 9 10 11 12",
    "build 20240131.4 passed 1500 tests",
    "lat 52.5200 long 13.4050 in Berlin",
    "table 4: 12 15 18 21 24 27",
    "3 of 10 and 7/8 of 9",
)
