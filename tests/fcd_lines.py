"""Text records for tests."""


def tsv(device, stamp, lon=22.948426, lat=40.626444, speed=30.0):
    return f"{device}\t{stamp}\t{lon}\t{lat}\t12.0\t{speed}\t90.0\t0"
