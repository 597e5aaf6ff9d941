"""Rows of the field's training table, labelled by hand: <<kind|span>>. The test's rows are others (tests/llm/pii_rows.py)."""

from __future__ import annotations

import re

#: The rows.
ROWS = """
Let me know on <<phone|(415) 555-0132>> whether you are coming.
The garage is on <<phone|408-555-0177>>, just leave a message.
My sister's phone: <<phone|(773) 555-0120>>.
After hours please use <<phone|555-0119>> instead.
He gave her <<phone|555-0108>> and a false name.
Office <<phone|213-555-0151>>; workshop <<phone|213-555-0152>>.
Home <<phone|555-0139>>; work <<phone|(402) 555-0128>>; pager <<phone|555-0140>>.
Work <<phone|604 555 0113>>, night desk <<phone|604 555 0114>>
Numbers: <<phone|604 555 0171>>, <<phone|604 555 0172>> and <<phone|604 555 0175>>.
Dispatch, <<phone|(913) 555-0185>>, will tell you more.
Whatsapp <<phone|628-555-0101>> or come by.
Tel <<phone|0044 161 555 0187>>, Manchester
In Berlin it is <<phone|0049 30 5551 2277>>, in Rome <<phone|0039 06 5550 1212>>.
Contact the warden (<<phone|828-555-0144>>) for a key.
Telephone <<phone|(512) 555 0162>> and ask for the manager.
Toll free: <<phone|888.555.0126>>
Sms to <<phone|347.555.0133>> works as well.
She keeps <<phone|555-0157>> on the fridge door.
The number I have for him is <<phone|555 0182>>.
Fax: <<phone|(514) 555-0194>>. Letters take longer.
Dial <<phone|541-555-0103>>!
Is <<phone|970-555-0115>> still right?
Box office <<phone|555-0161>>, daily.
Reach her under <<phone|(907) 555-0170>> at any time.
Write me at <<email|jan at waterfront dot org>> soon.
I am <<email|ruth at oldmill dot net>>, and I answer everything.
His mail is <<email|george at copperfield dot com>>.
Her address was <<email|nina at clockwork dot edu>>, now it is <<email|nina.h at clockwork dot edu>>.
You reach us at <<email|shop at tinker dot co dot uk>> all year.
It goes to <<email|info at harvest dot info>> first.
Send it to <<email|paul.w at meadow dot fr>> or to me.
Post your answer to <<email|quiz at radioseven dot com>> by noon.
Editor: <<email|m.stone at ledger dot org>>.
From <<email|e.brown at station dot net>> to <<email|k.white at station dot net>>
Talk to <<email|vera at granite dot com>> or ring <<phone|555-0129>>.
Ask for <<email|milo at anchor dot io>> if in doubt.
Complaints: <<email|care at bigstore dot com>>, please be kind.
We are <<email|office at parish dot gov>> on weekdays.
Mail to <<email|sara_b at hilltop dot de>> is read by two people.
Please tell <<email|carl at bakery dot se>> about it.
Contact <<email|news (at) valley.org>>.
Editors can be found at <<email|tips [at] gazette.com>>.
Questions go to <<email|help [at] softworks.net>>, not to the list.
Try <<email|root [at] bitmine.io>>. Or wait.
Sign up with <<email|join (at) chessclub (dot) org>> today.
Write <<email|a.keller (at) museum (dot) de>> for prints.
Old news is with <<email|archive [at] tribune [dot] com>>.
Ads: <<email|sales (at) kiosk.fr>>, notices: <<email|desk (at) kiosk.fr>>
He uses <<email|bo77 (at) mailbox (dot) net>> for games.
The list owner is <<email|owner at lists dot sailing dot org>>.
Her SSN is <<id|521-11-3384>>, she says.
SSN: <<id|402-88-1190>>
Social security <<id|601-23-7781>>, born in May.
The clerk copied ssn <<id|318-40-5526>> twice.
Enter your social security number, <<id|150-66-2093>>, below.
Passport <<id|448102937>> issued in Bonn.
Passport no. <<id|702913458>> was found on a bench.
His passport number is <<id|915527306>>.
Licence no <<id|830416725>> has lapsed.
Identity card: ID <<id|267714093>>
Member id <<id|560913842>>, class B.
The license number <<id|194082537>> belongs to a van.
We met on 12-08-2017 at noon.
Paid on 03-11-2021, receipt 2021-0457.
Invoice 1998-220 replaces invoice 1998-219.
Delivered 15-02-2020 at 16:40, signed by two.
Meet at 08:15 on platform 12.
Polka dot shirts were sold at the fair.
She wore a polka dot scarf at dinner.
Each dot stands for a town, each line for a road.
Connect dot to dot and look at the shape.
They work at night. Nobody sees them.
The dot matrix printer at work broke.
A dot of paint was left at the corner.
He arrived at ten. By noon he was gone.
Dot your letters and cross your lines.
Look at chapter 7. Then go on.
The dog barked at us.It was late.
It happened at home in 1964.
The class meets at school. Bring water.
Over 3000 people came in 2016, 450 more than in 2015.
The lake is 120 m deep, 14 km long and 3 km wide.
Take 2 cups of rice and 400 ml of water.
Pages 201-240 are missing, as is page 77.
He won 6-4, 7-5 and lost 3-6 later on.
Part 3300-1200 fits models 12 to 15.
Order 664-2210 left on Monday.
Room 114-2 is on floor 3.
Case 12-3344 was heard in 2004.
Highway 101 has 4 lanes for 1550 miles.
It sold 250,000 copies by 1985.
Between 1939-1945 nothing was built.
The code is 4471 and the door is 9.
Article 15, section 2, line 40.
Number 7 is open from 9 to 17.
We had 30 calls in 20 minutes.
Call number 812.54 is on shelf 6.
The phone cost 799 in 2018.
My mobile has 128 units of memory.
Her id tag says 12.
License 2.0 replaces license 1.1.
Section 4.2.1 lists 11 cases.
Bus 38 stops here at 7:05 and 7:35.
Batch 20190415-07 passed.
Hash 9f86d081884c7d659a2feaa0c55ad015 was stored.
The barcode reads 4006381333931.
It is 5 to 12.
""".strip().splitlines()


def labelled(rows: list[str] = ROWS) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, spans) of each row."""
    out = []
    for row in rows:
        text, spans = "", []
        for k, part in enumerate(re.split(r"<<(\w+\|[^>]*)>>", row)):
            if k % 2:
                kind, _, part = part.partition("|")
                spans.append((len(text), len(text) + len(part), kind))
            text += part
        out.append((text, spans))
    return out
