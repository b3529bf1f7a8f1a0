"""Hand-transcribed input rows and expected results."""

# D1: (type, key, event_time, customer_id or None, extra fields), in file order.
_TAG = {"some key": "some value"}


def _visit(key, time, customer, tags=_TAG):
    return {"type": "SITE_VISIT", "verb": "NEW", "key": key, "event_time": time, "customer_id": customer, "tags": tags}


def _image(key, time, customer, model="EOS 80D"):
    # The make field is misspelled in the data, so the make is missing.
    return {
        "type": "IMAGE", "verb": "UPLOAD", "key": key, "event_time": time, "customer_id": customer,
        "camera_mVAe": "Canon", "camera_model": model,
    }


def _order(key, time, customer, amount, verb="NEW"):
    return {"type": "ORDER", "verb": verb, "key": key, "event_time": time, "customer_id": customer, "total_amount": amount}


def _customer(key, time, last, city, state, verb="NEW"):
    event = {"type": "CUSTOMER", "verb": verb, "key": key, "event_time": time}
    event.update({k: v for k, v in (("last_name", last), ("adr_city", city), ("adr_state", state)) if v is not None})
    return event


visit, image, order, customer = _visit, _image, _order, _customer

C1, C4, C5, C10 = "96f55c7d8001", "96f55c7d8004", "96f55c7d8005", "96f55c7d8010"

D1_EVENTS = [
    image("d1ede43b1e9f", "2018-01-20T12:47:12.344Z", C10),
    order("68d84e5d1b43", "2018-01-20T12:55:55.555Z", C10, "1250.00 USD"),
    visit("ac05e815512g", "2018-01-22T12:45:52.041Z", C5),
    visit("ac05e815513f", "2018-01-26T12:45:52.041Z", C10),
    image("d8edh43b1e0f", "2018-01-26T12:47:12.344Z", C10),
    order("68d84e5d1e53", "2018-01-26T12:55:55.555Z", C10, "2000.00 USD"),
    customer(C5, "2018-01-26T12:56:12.384Z", "Michael", "Rockville", "MD"),
    visit("ac05e815513g", "2018-01-26T12:55:52.041Z", C5),
    image("d8ede53b1e0g", "2018-01-26T12:57:12.344Z", C5),
    order("68d84e5d1b54", "2018-01-27T12:55:55.555Z", C5, "2000.00 USD"),
    customer(C1, "2018-01-2000T12:46:12.384Z", "Jennifer", "Middletown", "VA"),
    visit("ac05e816513g", "2018-01-21T12:44:52.081Z", C1),
    image("d8eye43c1e0g", "2018-01-22T12:47:12.344Z", C1, "5500"),
    order("68d84e5d2b54", "2018-01-28T12:55:55.555Z", C1, "1250.00 USD"),
    customer(C4, "2018-02-28T12:56:12.384Z", "Bill", "Washington", "DC"),
    visit("ac05e816513h", "2018-02-22T12:54:52.081Z", C4),
    image("d8ede43c1e0z", "2018-02-05T12:57:12.344Z", C4, "5500"),
    order("68d84e5d2b55", "2018-02-12T12:55:55.555Z", C4, "50.00 USD"),
    customer(C10, "2018-01-06T12:45:52.041Z", "Andy", "Middletown", "VA"),
    visit("ac05e815502f", "2018-01-06T12:44:07.041Z", C10),
    image("d8ede86b1d9f", "2018-01-06T12:47:12.344Z", C10, "5500"),
    order("68d84e5d1a43", "2018-01-06T12:55:55.555Z", C10, "15.00 USD"),
    visit("ac05e815502g", "2018-01-09T12:45:52.041Z", C5),
    image("d8ede43b1t8g", "2018-01-07T12:47:12.344Z", C5),
    order("68d84e5d1a44", "2018-01-07T12:55:55.555Z", C5, "1250.00 USD"),
    visit("ac05e815503f", "2018-01-11T12:45:52.041Z", C10),
    image("d8ede48b1d0f", "2018-01-11T12:47:12.344Z", C10, "5500"),
    order("68d84e5d1a53", "2018-01-11T12.55:55.555Z", C10, "2000.00 USD"),
    visit("ac05e815503g", "2018-01-12T12:45:52.041Z", C5),
    visit("ac05e815512f", "2018-01-31T12:45:52.041Z", C10),
]

D1_RESULT = [
    [C5, ["Michael", "Rockville", "MD", 812.5, 2.0, 845000.0]],
    [C10, ["Andy", "Middletown", "VA", 1316.25, 1.0, 684450.0]],
    [C1, ["Jennifer", "Middletown", "VA", 1250.0, 1.0, 650000.0]],
    [C4, ["Bill", "Washington", "DC", 50.0, 1.0, 26000.0]],
]

# D2: relations with a customer listed twice.
E40, E45, E46, E48 = "96f55c7d8f40", "96f55c7d8f45", "96f55c7d8f46", "96f55c7d8f48"

D2_ORDERS = [
    ("68d84e5d1b43", "2017-01-20", E40, "25.00"),
    ("68d84e5d1e53", "2017-01-26", E40, "20.00"),
    ("68d84e5d1b54", "2017-01-27", E45, "20.00"),
    ("68d84e5d2b54", "2017-01-20", E46, "25.00"),
    ("78d84e5d2b54", "2017-02-25", E48, "50.00"),
    ("68d84e5d1a43", "2017-01-06", E40, "15.00"),
    ("68d84e5d1a44", "2017-01-07", E45, "25.00"),
    ("68d84e5d1a53", "2017-01-11", E40, "20.00"),
]
D2_VISITS = [
    ("ac05e815512g", "2017-01-21", E45),
    ("ac05e815513f", "2017-01-26", E40),
    ("ac05e815513g", "2017-01-26", E45),
    ("ac05e816513g", "2017-01-20", E46),
    ("bc05e816513g", "2017-02-20", E48),
    ("ac05e815502f", "2017-01-06", E40),
    ("ac05e815502g", "2017-01-07", E45),
    ("ac05e815503f", "2017-01-11", E40),
    ("ac05e815503g", "2017-01-12", E45),
    ("ac05e815512f", "2017-01-20", E40),
]
D2_CUSTOMERS = [
    (E45, "2017-01-26", "Michael", "Rockville", "MD"),
    (E46, "2017-01-20", "Linda", "Middletown", "AK"),
    (E48, "2017-02-20", "Bill", "Washington", "DC"),
    (E40, "2017-01-06", "Andy", "Middletown", "AK"),
    (E45, "2017-01-06", "Mike", "Rockville", "MD"),
]

# (customer, last name) -> (ltv, rank)
D2_RESULT = {
    (E48, "Bill"): (26000.0, 1),
    (E46, "Linda"): (13000.0, 2),
    (E40, "Andy"): (10400.0, 3),
    (E45, "Michael"): (5850.0, 4),
    (E45, "Mike"): (5850.0, 4),
}

# One event of each type, tags as an array.
SAMPLE_EVENTS = [
    customer("96f55c7d8f42", "2017-01-06T12:46:46.384Z", "Smith", "Middletown", "AK"),
    visit("ac05e815502f", "2017-01-06T12:45:52.041Z", "96f55c7d8f42", [_TAG]),
    {
        "type": "IMAGE", "verb": "UPLOAD", "key": "d8ede43b1d9f", "event_time": "2017-01-06T12:47:12.344Z",
        "customer_id": "96f55c7d8f42", "camera_make": "Canon", "camera_model": "EOS 80D",
    },
    order("68d84e5d1a43", "2017-01-06T12:55:55.555Z", "96f55c7d8f42", "12.34 USD"),
]

WEEK_DATES = ["2017-01-02", "2017-01-09", "2018-01-01", "2018-01-02", "2018-05-02", "2018-06-03"]
