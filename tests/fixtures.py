"""Small hand-made inputs in the log's and the catalogue's own format."""

import json

# Log rows with the format's key names; persons, titles and places are invented. Hard cases: commas, quotes,
# a wrongly decoded name.
LOG_ROWS = [
    {"artist": "Harbour Lanterns", "auth": "Logged In", "firstName": "Tomas", "gender": "M", "itemInSession": 53,
     "lastName": "Veld", "length": 201.07955, "level": "paid", "location": "Old Mill-St. Brannock, QX",
     "method": "PUT", "page": "NextSong", "registration": 1.540558e12, "sessionId": 954,
     "song": "Don't Wake the Tide", "status": 200, "ts": 1543449657796, "userAgent": "Mozilla/5.0 (Macintosh)",
     "userId": "73"},
    {"artist": "Copper Finch", "auth": "Logged In", "firstName": "Ines", "gender": "F", "itemInSession": 88,
     "lastName": "Marlow", "length": 143.92771, "level": "paid", "location": "Port Ellery-Dunmoor, ZY",
     "method": "PUT", "page": "NextSong", "registration": 1.541057e12, "sessionId": 984,
     "song": "Paper 2 Stone (Demo)", "status": 200, "ts": 1543449690796,
     "userAgent": "Mozilla/5.0 (Windows NT 6.1; WOW64)", "userId": "24"},
    {"artist": "9TO!5", "auth": "Logged In", "firstName": "Ines", "gender": "F", "itemInSession": 89,
     "lastName": "Marlow", "length": 205.522, "level": "paid", "location": "Port Ellery-Dunmoor, ZY",
     "method": "PUT", "page": "NextSong", "registration": 1.541057e12, "sessionId": 984,
     "song": "Her Last Map (Feat. Jo$ie) [Long Cut]", "status": 200, "ts": 1543449841796,
     "userAgent": "Mozilla/5.0 (Windows NT 6.1; WOW64)", "userId": "24"},
    {"artist": "SÃ\u0083Â¶lvgard", "auth": "Logged In", "firstName": "Tomas", "gender": "M",
     "itemInSession": 54, "lastName": "Veld", "length": 301.81506, "level": "paid",
     "location": "Old Mill-St. Brannock, QX", "method": "PUT", "page": "NextSong",
     "registration": 1.540558e12, "sessionId": 954, "song": "The Clock and The River", "status": 200,
     "ts": 1543449895796, "userAgent": "Mozilla/5.0 (Macintosh)", "userId": "73"},
    {"artist": "Velvet Quarry", "auth": "Logged In", "firstName": "Ines", "gender": "F", "itemInSession": 90,
     "lastName": "Marlow", "length": 187.25546, "level": "paid", "location": "Port Ellery-Dunmoor, ZY",
     "method": "PUT", "page": "NextSong", "registration": 1.541057e12, "sessionId": 984, "song": "Two Doors",
     "status": 200, "ts": 1543450033796, "userAgent": "Mozilla/5.0 (Windows NT 6.1; WOW64)", "userId": "24"},
    # a non-listen page of a logged-out visitor: no artist, no user
    {"artist": None, "auth": "Logged Out", "firstName": None, "gender": None, "itemInSession": 0,
     "lastName": None, "length": None, "level": "free", "location": None, "method": "GET", "page": "Home",
     "registration": None, "sessionId": 1000, "song": None, "status": 200, "ts": 1543450100000,
     "userAgent": None, "userId": ""},
    # the same user later at a free level
    {"artist": "Velvet Quarry", "auth": "Logged In", "firstName": "Ines", "gender": "F", "itemInSession": 91,
     "lastName": "Marlow", "length": 187.25546, "level": "free", "location": "Port Ellery-Dunmoor, ZY",
     "method": "PUT", "page": "NextSong", "registration": 1.541057e12, "sessionId": 984, "song": "Two Doors",
     "status": 200, "ts": 1543450300000, "userAgent": "Mozilla/5.0 (Windows NT 6.1; WOW64)", "userId": "24"},
]

SONG_DOCS = [
    {"num_songs": 1, "artist_id": "ARXYZ3K2298C005BC8", "artist_latitude": None, "artist_longitude": None,
     "artist_location": "", "artist_name": "Odile Marchbanks", "song_id": "SOQWERT12B7C5D9F0A",
     "title": "Das stille Ufer", "duration": 161.53125, "year": 0},
    {"num_songs": 1, "artist_id": "ARVELVET", "artist_latitude": 51.5, "artist_longitude": -0.1,
     "artist_location": "London", "artist_name": "Velvet Quarry", "song_id": "SOTWODOORS2",
     "title": "Two Doors", "duration": 187.25546, "year": 1983},
    # the same title/artist/duration twice: the lookup must take the smallest song_id
    {"num_songs": 1, "artist_id": "ARVELVET", "artist_latitude": 51.5, "artist_longitude": -0.1,
     "artist_location": "London", "artist_name": "Velvet Quarry", "song_id": "SOTWODOORS1",
     "title": "Two Doors", "duration": 187.25546, "year": 1983},
    {"num_songs": 1, "artist_id": "ARCOPPER", "artist_latitude": None, "artist_longitude": None,
     "artist_location": "NY", "artist_name": "Copper Finch", "song_id": "SOPAPER",
     "title": "Paper 2 Stone (Demo)", "duration": 143.92771, "year": 1992},
]


def write_json_lines(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
